"""Table names and schemas: the contract between jobs."""

from pyspark.sql import types as T

# Table names.
PRODUCT = "product"
RATING = "rating"
RATE_MORE_PRODUCTS = "RateMoreProducts"
RATE_MORE_RECENTLY = "RateMoreRecentlyProducts"
AVERAGE_PRODUCTS = "AverageProducts"
USER_RECS = "UserRecs"
PRODUCT_RECS = "ProductRecs"
ITEMCF_RECS = "ItemCFProductRecs"
CONTENT_RECS = "ContentBasedProductRecs"
STREAM_RECS = "StreamRecs"
USER = "User"

# Marker of a rating in the tracking log, list lengths, thresholds.
RATING_MARKER = "PRODUCT_RATING_PREFIX:"
QUEUE_SIZE = 40
RECENT_SIZE = 21
LIST_SIZE = 20
SIM_THRESHOLD = 0.4
LIKE_ABOVE = 3
HASHED_FEATURES = 800

# Matrix factorisation settings and the model-selection grid.
ALS_RANK = 5
ALS_ITERATIONS = 10
ALS_LAMBDA = 0.01
GRID_RANKS = (100, 200, 250)
GRID_LAMBDAS = (1.0, 0.1, 0.01, 0.001)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_long, _int, _dbl, _str = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()

REC_LIST = T.ArrayType(_struct(("product_id", _long), ("score", _dbl)))

SCHEMAS = {
    PRODUCT: _struct(("product_id", _long), ("name", _str), ("image_url", _str),
                     ("categories", _str), ("tags", _str)),
    RATING: _struct(("user_id", _long), ("product_id", _long), ("score", _dbl), ("ts", _long)),
    RATE_MORE_PRODUCTS: _struct(("product_id", _long), ("count", _long)),
    RATE_MORE_RECENTLY: _struct(("product_id", _long), ("count", _long), ("yearmonth", _int)),
    AVERAGE_PRODUCTS: _struct(("product_id", _long), ("avg", _dbl)),
    USER_RECS: _struct(("user_id", _long), ("recs", REC_LIST)),
    # Uncapped, so one row per pair rather than one list per product.
    PRODUCT_RECS: _struct(("product_id", _long), ("rec_id", _long), ("sim", _dbl),
                          ("place", _int)),
    ITEMCF_RECS: _struct(("product_id", _long), ("recs", REC_LIST)),
    CONTENT_RECS: _struct(("product_id", _long), ("recs", REC_LIST)),
    STREAM_RECS: _struct(("user_id", _long), ("recs", REC_LIST)),
    USER: _struct(("user_id", _long), ("username", _str), ("first", T.BooleanType()),
                  ("ts", _long), ("pref_genres", T.ArrayType(_str))),
}
