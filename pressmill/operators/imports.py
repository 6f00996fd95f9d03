"""Import of article records and upkeep of batches."""

from pyspark.sql import Column, DataFrame, functions as F

from pressmill.functions.json_text import one_record
from pressmill.schemas import (
    ARTICLE, ARTICLE_FIELDS, BOOLEAN, INTEGER, LIST, METADATA, OBJECT, STRING, TAGS, UNPROCESSED,
)
from pressmill.session import settle

# Texts that count as true and false.
TRUE_TEXTS = ["1", "on", "t", "true", "y", "yes"]
FALSE_TEXTS = ["0", "off", "f", "false", "n", "no"]
# A whole number, also as a text or with a zero fraction.
WHOLE_NUMBER = "^ *[+-]?[0-9]+([.]0*)? *$"


# Conversions of a variant ``{v}`` of JSON type ``{t}``, null where it does not fit.
_TEXT_OF = "try_variant_get({v}, '$', 'string')"
_IS_NUMBER = "({t} = 'BIGINT' OR {t} LIKE 'DECIMAL%' OR {t} IN ('DOUBLE', 'FLOAT'))"
_IN = lambda texts: "(" + ", ".join(f"'{t}'" for t in texts) + ")"
_PARTS_FIT = " AND ".join(
    f"coalesce(schema_of_variant(variant_get({{v}}, '$.{field.name}')), 'VOID') RLIKE '^(VOID|OBJECT)'"
    for field in METADATA
)
CONVERT = {
    STRING: f"CASE WHEN {{t}} = 'STRING' THEN {_TEXT_OF} END",
    INTEGER: f"""CASE WHEN {{t}} = 'BOOLEAN' THEN CAST(try_variant_get({{v}}, '$', 'boolean') AS BIGINT)
        WHEN {{t}} IN ('DOUBLE', 'FLOAT') THEN CASE WHEN try_variant_get({{v}}, '$', 'double') = floor(try_variant_get({{v}}, '$', 'double'))
            THEN TRY_CAST(try_variant_get({{v}}, '$', 'double') AS BIGINT) END
        WHEN ({{t}} = 'STRING' OR {_IS_NUMBER}) AND {_TEXT_OF} RLIKE '{WHOLE_NUMBER}'
            THEN TRY_CAST(split_part(trim({_TEXT_OF}), '.', 1) AS BIGINT) END""",
    BOOLEAN: f"""CASE WHEN {{t}} = 'BOOLEAN' THEN try_variant_get({{v}}, '$', 'boolean')
        WHEN {{t}} = 'STRING' THEN CASE WHEN lower({_TEXT_OF}) IN {_IN(TRUE_TEXTS)} THEN true
            WHEN lower({_TEXT_OF}) IN {_IN(FALSE_TEXTS)} THEN false END
        WHEN {_IS_NUMBER} THEN CASE try_variant_get({{v}}, '$', 'double') WHEN 1 THEN true WHEN 0 THEN false END END""",
    OBJECT: f"""CASE WHEN {{t}} LIKE 'OBJECT%' AND {_PARTS_FIT}
        THEN try_variant_get({{v}}, '$', '{METADATA.simpleString()}') END""",
    # an absent list means an empty one; an explicit null stays null
    LIST: f"""CASE WHEN {{v}} IS NULL THEN CAST(array() AS {TAGS.simpleString()})
        WHEN {{t}} LIKE 'ARRAY%' AND forall(try_variant_get({{v}}, '$', 'array<variant>'),
            i -> schema_of_variant(i) LIKE 'OBJECT%') THEN try_variant_get({{v}}, '$', '{TAGS.simpleString()}') END""",
}


def check_articles(lines: DataFrame, value: str = "value") -> DataFrame:
    """Add ``article`` (the typed record) and ``reasons`` (why it is refused).

    A reason is ``missing:<field>`` for an absent required key, ``type:<field>``
    for a value of the wrong type, or ``malformed`` for a line that is no object.
    Each line is parsed once, into the known fields only; unknown keys drop out.
    """
    settle(lines)
    fields = ", ".join(f"{name}: variant" for name, _, _ in ARTICLE_FIELDS)
    # the generator keeps the parse from being repeated for every field
    parsed = lines.select("*", F.posexplode_outer(F.expr(one_record(value, fields))).alias("_n", "_r"))
    kinds = parsed.withColumns({
        f"_kind_{name}": F.expr(f"schema_of_variant(_r.{name})") for name, _, _ in ARTICLE_FIELDS
    })
    converted = kinds.withColumns({
        f"_new_{name}": F.expr(CONVERT[kind].format(v=f"_r.{name}", t=f"_kind_{name}"))
        for name, kind, _ in ARTICLE_FIELDS
    })
    reasons = ["CASE WHEN _n IS NULL THEN 'malformed' END"]
    for name, _, required in ARTICLE_FIELDS:
        absent = f"CASE WHEN _n IS NOT NULL AND _r.{name} IS NULL THEN 'missing:{name}'" if required else "CASE"
        reasons.append(f"{absent} WHEN _kind_{name} <> 'VOID' AND _new_{name} IS NULL THEN 'type:{name}' END")
    return converted.select(
        *lines.columns,
        F.struct(*[F.col(f"_new_{name}").alias(name) for name, _, _ in ARTICLE_FIELDS]).alias("article"),
        F.expr(f"array_compact(array({', '.join(reasons)}))").alias("reasons"),
    )


def validate_articles(lines: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Split records into ``(accepted, rejected)``; rejected rows keep their reasons."""
    return split_checked(check_articles(lines, value), value)


def split_checked(checked: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """``(accepted, rejected)`` of checked records; write these first, so that both parse once."""
    kept = [c for c in checked.columns if c not in (value, "article", "reasons")]
    accepted = checked.filter(F.size("reasons") == 0).select(*kept, "article.*")
    rejected = checked.filter(F.size("reasons") > 0).drop("article")
    return accepted, rejected


def stamp_articles(accepted: DataFrame, batch_id: Column | int, file: str = "file") -> DataFrame:
    """Give accepted records their batch, origin, defaults and id.

    The id is a random one per row, as a document store would give; write the
    result once before using it twice.
    """
    batch_id = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
    stamped = accepted.withColumns({
        "lang": F.col("language"),
        "article_id": F.uuid(),
        "batch_id": batch_id,
        "imported_from": F.coalesce(F.col(file), F.lit("unspecified")),
        "imported_at": F.current_timestamp(),
        "scraping_result": F.lit(None),
        "status": F.lit(UNPROCESSED),
        "tries": F.lit(0),
    })
    return stamped.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ARTICLE])


def latest_batch_id(articles: DataFrame) -> DataFrame:
    """One row: the highest batch id, 0 for an empty table."""
    return articles.agg(F.coalesce(F.max("batch_id"), F.lit(0)).cast("bigint").alias("batch_id"))


def next_batch_id(articles: DataFrame) -> DataFrame:
    """One row: the id for the next batch.  Use it as ``next_batch_id(…).scalar()``."""
    return latest_batch_id(articles).select((F.col("batch_id") + 1).alias("batch_id"))


def first_open_batch_id(articles: DataFrame, status: str = UNPROCESSED) -> DataFrame:
    """One row: the lowest batch id that still has rows of the status, else 0."""
    open_rows = articles.filter(F.col("status") == status)
    return open_rows.agg(F.coalesce(F.min("batch_id"), F.lit(0)).cast("bigint").alias("batch_id"))


def delete_batch(articles: DataFrame, batch_id: Column | int) -> DataFrame:
    """Rows that are not in the batch; rows without a batch id stay."""
    batch_id = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
    return articles.filter(~F.col("batch_id").eqNullSafe(batch_id))


def append_articles(articles: DataFrame, new: DataFrame) -> DataFrame:
    """All rows of both tables; columns missing on one side are null."""
    return articles.unionByName(new, allowMissingColumns=True)
