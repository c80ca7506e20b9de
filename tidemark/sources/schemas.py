"""The schemas of what is landed and of the listings that are made from it."""

CITY = "struct<id:string,name:string,region:struct<id:string,name:string,slug:string>>"
MEDIA = "struct<mediaUrl:string,mimeType:string,thumbnail:string>"

#: A record of the announcements API, in its detail or its summary form.
ANNOUNCEMENT = f"""
    id string, reference string, title string, slug string, description string, createdAt string, refreshedAt string,
    price variant, pricePreview variant, oldPrice variant, priceType string, exchangeType string, priceUnit string,
    hasDelivery boolean, deliveryType string, hasPhone boolean, hasEmail boolean, quantity bigint, status string, street_name string,
    category struct<id:string,slug:string,name:string,deliveryType:string,parentTree:array<struct<id:string,name:string,slug:string>>>,
    defaultMedia {MEDIA}, medias array<{MEDIA}>,
    categories array<struct<id:string,name:string,slug:string,parentId:string>>,
    specs array<struct<specification:struct<label:string,codename:string,type:string>,value:variant,valueText:variant>>,
    smallDescription array<struct<specification:struct<codename:string>,valueText:variant>>,
    user struct<id:string,displayName:string>, isFromStore boolean,
    store struct<id:string,name:string,slug:string,description:string,url:string,followerCount:bigint,announcementsCount:bigint,status:string,
        isOfficial:boolean,isVerified:boolean,locations:array<struct<location:struct<address:string,region:struct<slug:string,name:string>>>>,
        categories:array<struct<name:string,slug:string>>>,
    cities array<{CITY}>, variants variant
"""

#: A page of search results, the category menu, and the children of a category, as landed.
SEARCH_PAGE = "search struct<announcements:struct<data:array<variant>,paginatorInfo:struct<hasMorePages:boolean,lastPage:bigint,total:bigint>>>"
MENU = "listingMenu array<struct<target:struct<id:string,name:string,slug:string>>>"
CHILDREN = "search struct<active:struct<category:struct<children:array<struct<slug:string>>>>>"

LISTING = """
    source string, external_id string, url string, title string, category string, subcategory string,
    price struct<amount:double,currency:string,raw:string,unit:string>, location struct<wilaya:string,commune:string,raw:string>,
    description string, published_at string, seller struct<display_name:string,type:string>, attributes variant,
    images array<struct<url:string,position:int,alt:string,width:int,height:int,source:string>>,
    source_metadata variant, scraped_at string, content_hash string
"""
LISTING_COLUMNS = ("source", "external_id", "url", "title", "category", "subcategory", "price", "location", "description", "published_at", "seller", "attributes", "images", "source_metadata", "scraped_at", "content_hash")

QUEUE_STATUSES = ("DISCOVERED", "PROCESSING", "SUCCESS", "FAILED", "SKIPPED")
FETCH_LOG = "run_id string, seq bigint, url string, status int, headers map<string,string>, body string, error string"
