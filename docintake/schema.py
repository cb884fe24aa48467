"""Table schemas, as Spark DDL.

Headers are kept as a sorted array of (name, values) and not as a map, because
origins must be comparable and Spark cannot compare maps.
"""

META = "struct<key:string,vtype:string,value:string>"
HEADERS = "array<struct<name:string,values:array<string>>>"
ORIGIN = (
    f"struct<scheme:string,hostname:string,uri:string,headers:{HEADERS},"
    f"metadata:array<{META}>>"
)
ATTRS = (
    "struct<path:string,name:string,mtime:timestamp_ntz,ctime:timestamp_ntz,"
    "atime:timestamp_ntz,size:bigint>"
)

MESSAGE = (
    f"seq bigint, source string, origins array<{ORIGIN}>, tags array<string>, "
    f"metadata array<{META}>, derivative boolean, verify boolean"
)
CATALOG = (
    "doc_id string, source string, hash string, mimetype string, "
    "created timestamp_ntz, updated timestamp_ntz, derivative boolean, "
    f"derivatives array<string>, attrs {ATTRS}, tags array<string>, "
    f"metadata array<{META}>, origin array<{ORIGIN}>, uuid string, rogue_file boolean"
)
MAPPINGS = (
    "mapping_id string, parent string, child string, child_path string, "
    f"metadata array<{META}>, consumer string"
)
FILES = "path string, length bigint, md5 string, mtime timestamp_ntz, kind string"
CAPTURES = (
    f"uri string, status int, location string, headers {HEADERS}, "
    "md5 string, length bigint, kind string, fetched timestamp_ntz"
)
FLAGS = (
    "doc_id string, consumer string, version string, "
    "started timestamp_ntz, ended timestamp_ntz"
)
OP_LOG = (
    "ts timestamp_ntz, consumer string, operation string, scheme string, "
    "mimetype string, seconds double, bytes bigint"
)

# JSON form of a message: headers come as an object, origins under either name.
_JSON_ORIGIN = (
    "struct<scheme:string,hostname:string,uri:string,"
    f"headers:map<string,array<string>>,metadata:array<{META}>>"
)
MESSAGE_JSON = (
    f"source string, origin array<{_JSON_ORIGIN}>, origins array<{_JSON_ORIGIN}>, "
    f"tags array<string>, metadata array<{META}>, derivative boolean, verify boolean, "
    "_corrupt string"
)
