"""Explicit schemas and fixed domains; nothing in the engine infers a schema."""

from pyspark.sql import types as T

PRICE_TYPE = T.DecimalType(20, 8)
AMOUNT_TYPE = T.DecimalType(20, 2)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Landed JSON.
COIN_LIST = _struct(id=T.StringType(), symbol=T.StringType(), name=T.StringType())

MARKET = _struct(
    id=T.StringType(),
    # Numbers may arrive as text; the clean step casts them.
    current_price=T.StringType(),
    market_cap=T.StringType(),
    total_volume=T.StringType(),
)

HISTORY = T.MapType(
    T.StringType(),
    _struct(prices=T.ArrayType(T.ArrayType(T.DoubleType()))),
)

COIN_DETAILS = _struct(id=T.StringType(), description=_struct(en=T.StringType()))

DESCRIPTIONS = T.MapType(T.StringType(), T.StringType())

# Curated data, between transform and load.
CURATED_DIM = _struct(
    coin_id=T.StringType(),
    symbol=T.StringType(),
    name=T.StringType(),
    loaded_at=T.TimestampNTZType(),
)

CURATED_SNAPSHOT = _struct(
    coin_id=T.StringType(),
    price_usd=T.DoubleType(),
    market_cap_usd=T.DoubleType(),
    volume_24h_usd=T.DoubleType(),
    price_date=T.DateType(),
    processed_at=T.TimestampNTZType(),
)

CURATED_HISTORY = _struct(
    coin_id=T.StringType(),
    price_date=T.DateType(),
    price_usd=T.DoubleType(),
    processed_at=T.TimestampNTZType(),
)

# Final tables.
DIM = T.StructType(CURATED_DIM.fields + [T.StructField("description", T.StringType())])

FACT = _struct(
    coin_id=T.StringType(),
    price_date=T.DateType(),
    price_usd=PRICE_TYPE,
    market_cap_usd=AMOUNT_TYPE,
    volume_24h_usd=AMOUNT_TYPE,
    processed_at=T.TimestampNTZType(),
)

RUN_LOG = _struct(
    run_date=T.TimestampNTZType(),
    stage=T.StringType(),
    status=T.StringType(),
    rows_processed=T.LongType(),
    error_message=T.StringType(),
)

# Days of a month with a price, as bits from the first day on, and the first of them.
COVERAGE = _struct(coin_id=T.StringType(), present=T.IntegerType(), earliest=T.DateType())

FACT_KEYS = ["coin_id", "price_date"]
FACT_MEASURES = ["price_usd", "market_cap_usd", "volume_24h_usd", "processed_at"]
CRITICAL_COLUMNS = ["coin_id", "price_date", "price_usd"]

# Storage partition columns, derived from the key so a row never moves between partitions.
FACT_PARTITION = "price_month"
FACT_DAY = "price_day"  # the day itself once more, below its month
DIM_PARTITION = "coin_bucket"
DIM_BUCKETS = 16

# Run-log domains, varchar lengths, pass mark.
STAGES = ("extraction", "transformation", "loading")
STATUSES = ("running", "success", "failed")
MAX_LENGTH = {"coin_id": 100, "symbol": 100, "name": 300, "stage": 50, "status": 20}
PASS_MARK = 80.0
LOOKBACK_DAYS = 30
