import re
import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions.text import ZERO_WIDTH, clean_text

CASES = ["", "   ", None, "a  b", "  x\ty ", "été", "a​b", "a b\x00c", "p\r\n\r\n\r\n\r\nq", "l1  \n  l2\n\n\n\nl3 \n", " wide　", "a\x85b", "﻿x", "tab\t\tend\t\n"]


def model(x, keep):
    """The same cleaning, written in plain Python."""
    if x is None:
        return None
    x = unicodedata.normalize("NFC", x)
    x = "".join(c for c in x if c not in ZERO_WIDTH and not (ord(c) < 32 and c not in "\t\n\r") and c != "\x7f")
    x = x.replace(" ", " ").replace("\r\n", "\n").replace("\r", "\n")
    if keep:
        x = "\n".join(re.sub("[ \t]+", " ", part).strip() for part in x.split("\n"))
        x = re.sub("\n{3,}", "\n\n", x)
    else:
        x = " ".join(x.split())
    return x.strip() or None


def test_cases(values):
    for keep in (False, True):
        assert values(clean_text(F.col("x"), keep), CASES) == [model(x, keep) for x in CASES]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=st.sampled_from("ab \t\n\réé​  　\x0b\x1f.")), min_size=1, max_size=40))
def test_any_text(values, xs):
    for keep in (False, True):
        assert values(clean_text(F.col("x"), keep), xs) == [model(x, keep) for x in xs]
