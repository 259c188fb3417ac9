"""Column layouts of the stage tables, declared once."""

from pyspark.sql import types as T

STATES = T.StructType(
    [
        T.StructField("household_id", T.IntegerType()),
        T.StructField("entity_id", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("last_updated_ts", T.TimestampType()),
        T.StructField("attributes_id", T.LongType()),
    ]
)

STATE_ATTRIBUTES = T.StructType(
    [T.StructField("attributes_id", T.LongType()), T.StructField("shared_attrs", T.StringType())]
)

# Attribute keys the pipelines use; other keys stay reachable through the JSON text.
ATTRIBUTE_FIELDS = T.StructType(
    [
        T.StructField("unit_of_measurement", T.StringType()),
        T.StructField("friendly_name", T.StringType()),
        T.StructField("device_class", T.StringType()),
        T.StructField("restored", T.BooleanType()),
        T.StructField("calibration", T.StructType([T.StructField("offset", T.DoubleType())])),
    ]
)

HOUSEHOLD_CSV = T.StructType(
    [T.StructField("Time", T.TimestampType()), T.StructField("Unix", T.LongType())]
    + [T.StructField(f"Appliance{i}", T.DoubleType()) for i in range(10)]
    + [T.StructField("Issues", T.IntegerType())]
)

PRICE_CSV = T.StructType([T.StructField("interval", T.StringType()), T.StructField("price", T.DoubleType())])

CONFIG_JSON = T.StructType(
    [
        T.StructField("data", T.StructType([T.StructField("household", T.IntegerType())])),
        T.StructField(
            "user_input",
            T.StructType(
                [
                    T.StructField("shiftable_devices", T.ArrayType(T.StringType())),
                    T.StructField("active_appliances", T.ArrayType(T.StringType())),
                    T.StructField("threshold", T.DoubleType()),
                ]
            ),
        ),
    ]
)

WEATHER_COLUMNS = ["temp", "dwpt", "rhum", "wdir", "wspd"]
