"""Column types of the source tables, ids of 64 bits. Read with these; never infer
in production."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


ORDERS = _struct(
    order_id=T.LongType(),
    user_id=T.LongType(),
    eval_set=T.StringType(),
    order_number=T.IntegerType(),
    order_dow=T.ByteType(),
    order_hour_of_day=T.ByteType(),
    days_since_prior_order=T.DoubleType(),
)

ORDER_LINES = _struct(
    order_id=T.LongType(),
    product_id=T.LongType(),
    add_to_cart_order=T.IntegerType(),
    reordered=T.ByteType(),
)

PRODUCTS = _struct(
    product_id=T.LongType(),
    product_name=T.StringType(),
    aisle_id=T.LongType(),
    department_id=T.LongType(),
)

AISLES = _struct(aisle_id=T.LongType(), aisle=T.StringType())

DEPARTMENTS = _struct(department_id=T.LongType(), department=T.StringType())

ORDER_LISTS = _struct(order_id=T.LongType(), products=T.StringType())

ORDER_STREAKS = _struct(
    user_id=T.LongType(),
    product_id=T.LongType(),
    order_streak=T.IntegerType(),
)

# File name of each source table.
CSV_FILES = {
    "prior": ("order_products__prior.csv", ORDER_LINES),
    "train": ("order_products__train.csv", ORDER_LINES),
    "orders": ("orders.csv", ORDERS),
    "products": ("products.csv", PRODUCTS),
    "aisles": ("aisles.csv", AISLES),
    "departments": ("departments.csv", DEPARTMENTS),
    "sample_submission": ("sample_submission.csv", ORDER_LISTS),
    "order_streaks": ("order_streaks.csv", ORDER_STREAKS),
}

# Columns of the training matrix, by origin.
PAIR_KEYS = ["user_id", "product_id"]
PAIR_FEATURES = [
    "_up_order_count",
    "_up_first_order_number",
    "_up_last_order_number",
    "_up_average_cart_position",
]
PRODUCT_FEATURES = [
    "_prod_tot_cnts",
    "_prod_reorder_tot_cnts",
    "_prod_buy_first_time_total_cnt",
    "_prod_buy_second_time_total_cnt",
    "_prod_reorder_prob",
    "_prod_reorder_ratio",
    "_prod_reorder_times",
]
USER_FEATURES = [
    "_user_total_orders",
    "_user_sum_days_since_prior_order",
    "_user_mean_days_since_prior_order",
    "_user_total_products",
    "_user_distinct_products",
    "_user_reorder_ratio",
    "_user_average_basket",
]
LAST_ORDER = ["order_id", "eval_set", "time_since_last_order"]
PAIR_RATES = [
    "_up_order_rate",
    "_up_order_since_last_order",
    "_up_order_rate_since_first_order",
]
LABEL = "reordered"
MATRIX = (
    PAIR_KEYS
    + PAIR_FEATURES
    + PRODUCT_FEATURES
    + USER_FEATURES
    + LAST_ORDER
    + PAIR_RATES
    + [LABEL, "aisle_id", "department_id", "order_streak"]
)
MODEL_FEATURES = [
    c for c in MATRIX if c not in PAIR_KEYS + ["order_id", "eval_set", LABEL]
]

_COUNTS = {
    *PAIR_KEYS,
    *PAIR_FEATURES[:3],
    *PRODUCT_FEATURES[:4],
    "_user_total_orders",
    "_user_total_products",
    "_user_distinct_products",
    "order_id",
    "_up_order_since_last_order",
    LABEL,
    "aisle_id",
    "department_id",
    "order_streak",
}
MATRIX_TYPES = _struct(
    **{
        c: T.StringType() if c == "eval_set" else T.LongType() if c in _COUNTS else T.DoubleType()
        for c in MATRIX
    }
)
