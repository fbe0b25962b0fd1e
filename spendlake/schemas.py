"""Declared schemas of sources, dimensions and the fact table."""

from __future__ import annotations

from pyspark.sql import types as T

# Source amounts carry more decimals than storage keeps; scale and round later.
SOURCE_NUMBER = T.DecimalType(28, 8)
MONEY = T.DecimalType(14, 2)
ACRES = T.DecimalType(10, 2)
RATIO = T.DecimalType(38, 10)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


STATES = _struct(code=T.StringType(), name=T.StringType())
TITLES = _struct(id=T.IntegerType(), name=T.StringType(), description=T.StringType())
SUBTITLES = _struct(id=T.IntegerType(), title_id=T.IntegerType(), name=T.StringType())
PROGRAMS = _struct(
    id=T.IntegerType(),
    title_id=T.IntegerType(),
    subtitle_id=T.IntegerType(),
    name=T.StringType(),
)
SUB_PROGRAMS = _struct(id=T.IntegerType(), program_id=T.IntegerType(), name=T.StringType())
SUB_SUB_PROGRAMS = _struct(id=T.IntegerType(), sub_program_id=T.IntegerType(), name=T.StringType())
PRACTICE_CATEGORIES = _struct(
    id=T.IntegerType(),
    name=T.StringType(),
    display_name=T.StringType(),
    category_grouping=T.StringType(),
    program_id=T.IntegerType(),
    is_statutory_category=T.BooleanType(),
)
PRACTICES = _struct(
    code=T.StringType(),
    name=T.StringType(),
    display_name=T.StringType(),
    source=T.StringType(),
)

PAYMENTS = _struct(
    id=T.LongType(),
    title_id=T.IntegerType(),
    subtitle_id=T.IntegerType(),
    program_id=T.IntegerType(),
    sub_program_id=T.IntegerType(),
    sub_sub_program_id=T.IntegerType(),
    practice_category_id=T.IntegerType(),
    state_code=T.StringType(),
    year=T.IntegerType(),
    payment=MONEY,
    recipient_count=T.LongType(),
    base_acres=ACRES,
    farm_count=T.LongType(),
    contract_count=T.LongType(),
    premium_policy_count=T.LongType(),
    liability_amount=T.LongType(),
    premium_amount=T.LongType(),
    premium_subsidy_amount=T.LongType(),
    indemnity_amount=T.LongType(),
    farmer_premium_amount=T.LongType(),
    loss_ratio=RATIO,
    net_farmer_benefit_amount=T.LongType(),
    practice_code=T.StringType(),
    practice_code_variant=T.StringType(),
)

# Column -> greatest text length.
PAYMENT_LENGTHS = {"state_code": 2, "practice_code": 100, "practice_code_variant": 100}
DIMENSION_LENGTHS = {
    "states": {"code": 2, "name": 100},
    "titles": {"name": 100},
    "subtitles": {"name": 100},
    "programs": {"name": 100},
    "sub_programs": {"name": 100},
    "sub_sub_programs": {"name": 100},
    "practices": {"code": 100, "name": 200, "display_name": 200},
}
DIMENSION_REQUIRED = {
    "states": ["code", "name"],
    "titles": ["id", "name"],
    "subtitles": ["id", "title_id", "name"],
    "programs": ["id"],
    "sub_programs": ["id", "program_id"],
    "sub_sub_programs": ["id", "sub_program_id"],
    "practice_categories": ["id", "name", "program_id", "is_statutory_category"],
    "practices": ["code", "name"],
}
# Column of the facts -> (dimension, key).
PAYMENT_REFERENCES = {
    "title_id": ("titles", "id"),
    "subtitle_id": ("subtitles", "id"),
    "program_id": ("programs", "id"),
    "sub_program_id": ("sub_programs", "id"),
    "sub_sub_program_id": ("sub_sub_programs", "id"),
    "practice_category_id": ("practice_categories", "id"),
    "state_code": ("states", "code"),
    "practice_code": ("practices", "code"),
}
# (dimension, column) -> (parent dimension, key).
DIMENSION_REFERENCES = {
    ("subtitles", "title_id"): ("titles", "id"),
    ("programs", "title_id"): ("titles", "id"),
    ("programs", "subtitle_id"): ("subtitles", "id"),
    ("sub_programs", "program_id"): ("programs", "id"),
    ("sub_sub_programs", "sub_program_id"): ("sub_programs", "id"),
    ("practice_categories", "program_id"): ("programs", "id"),
}
PAYMENT_UNIQUE = ["title_id", "subtitle_id", "program_id", "sub_program_id", "state_code", "year"]
