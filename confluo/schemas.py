"""Column layouts shared by every stage."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _I, _D, _B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


CATALOGUE = _struct(
    source=_S,
    id=_S,
    entity_id=_S,
    name=_S,
    storyline=_S,
    summary=_S,
    genres=T.ArrayType(_S),
    platforms=T.ArrayType(_S),
    devs=T.ArrayType(_S),
    date=T.TimestampType(),
    popularity=_L,
)

# --- Fixed values: field names of the two raw formats, so that existing dumps can be read. ---
NAMED = _struct(name=_S)

RATINGS_API = _struct(
    id=_L,
    name=_S,
    storyline=_S,
    summary=_S,
    genres=T.ArrayType(NAMED),
    platforms=T.ArrayType(NAMED),
    involved_companies=T.ArrayType(_struct(company=NAMED, developer=_B)),
    release_dates=T.ArrayType(_struct(date=_L)),
    total_rating_count=_L,
)

RATINGS_DUMP = _struct(
    id=_L,
    name=_S,
    storyline=_S,
    summary=_S,
    genres=T.ArrayType(_S),
    platforms=T.ArrayType(_S),
    dev_companies=T.ArrayType(_S),
    release_date=_L,
    total_rating_count=_L,
)

STORE_KEEP = [
    "type",
    "name",
    "steam_appid",
    "required_age",
    "is_free",
    "detailed_description",
    "about_the_game",
    "short_description",
    "supported_languages",
    "website",
    "developers",
    "price_overview",
    "platforms",
    "metacritic",
    "categories",
    "genres",
    "recommendations",
    "release_date",
    "content_descriptors",
]

STORE_DUMP = _struct(
    type=_S,
    name=_S,
    steam_appid=_L,
    required_age=_S,
    is_free=_B,
    detailed_description=_S,
    about_the_game=_S,
    short_description=_S,
    supported_languages=_S,
    website=_S,
    developers=T.ArrayType(_S),
    price_overview=_struct(currency=_S, initial=_L, final=_L, discount_percent=_I),
    platforms=T.MapType(_S, _B),
    metacritic=_struct(score=_I, url=_S),
    categories=T.ArrayType(_struct(id=_L, description=_S)),
    genres=T.ArrayType(_struct(id=_S, description=_S)),
    recommendations=_struct(total=_L),
    release_date=_struct(coming_soon=_B, date=_S),
    content_descriptors=_struct(ids=T.ArrayType(_L), notes=_S),
    failed=_B,
    redirect=_L,
)

STORE_REPLY = _struct(success=_B, data=STORE_DUMP)
# --- End of fixed values. ---

TEXT_FIELDS = ["name", "storyline", "summary"]
KEYWORD_FIELDS = ["genres", "platforms", "devs"]
DATE_FIELD = "date"
