"""News articles: one JSON object per line, body as an array of content items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quillrank.functions.binding import let

# The field names of the corpus format.
CONTENT_ITEM = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "content", "subtype", "type", "mime",
            "fullcaption", "imageURL", "imageHeight", "imageWidth", "blurb",
            "role", "name", "bio", "kicker",
        )
    ]
)

ARTICLE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("article_url", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("published_date", T.LongType()),  # unix milliseconds
        T.StructField("contents", T.ArrayType(CONTENT_ITEM)),
        T.StructField("type", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
)

# All that ranking looks at. A narrower schema leaves the other fields unparsed.
RANKED_FIELDS = T.StructType(
    [
        ARTICLE["id"],
        ARTICLE["title"],
        T.StructField(
            "contents", T.ArrayType(T.StructType([CONTENT_ITEM["content"], CONTENT_ITEM["subtype"]]))
        ),
    ]
)

CORRUPT = "_corrupt_record"


def read_articles(spark: SparkSession, path: str, schema: T.StructType = ARTICLE) -> DataFrame:
    """Articles below ``path``; a broken line fails. ``read_with_rejects`` sets such lines apart."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def decode_articles(line: Column, schema: T.StructType = ARTICLE) -> Column:
    """A JSON line as an article struct. Fields the schema does not name are ignored; a broken line fails."""
    return F.from_json(line, schema, {"mode": "FAILFAST"})


def _accepts(kind: T.DataType) -> str:
    """What ``schema_of_variant`` may say of a value of a field of this type. Any scalar has a text; numbers are whole ones."""
    scalar = "STRING|BOOLEAN|BIGINT|DOUBLE|DECIMAL\\(.*\\)|FLOAT|DATE|TIMESTAMP|TIMESTAMP_NTZ|BINARY|UUID"
    return {"string": scalar, "bigint": "BIGINT"}[kind.simpleString()] + "|VOID"


def wrong_field(line: Column, schema: T.StructType = ARTICLE) -> Column:
    """The first field of an article whose JSON value is of the wrong kind, as a path; null where there is none.

    An object or a list in the place of a text, a text in that of a number, anything but a list of objects for the content
    items. Fields that the schema does not name may hold anything; null and missing are right everywhere.
    """
    return let(F.try_parse_json(line), lambda value: _wrong_field(value, schema))


def _wrong_field(value: Column, schema: T.StructType) -> Column:
    def kind(v: Column, path: str) -> Column:
        return F.schema_of_variant(F.try_variant_get(v, path, "variant"))

    def check(v: Column, prefix: str, field: T.StructField) -> Column:
        return F.when(~kind(v, f"$.{field.name}").rlike(f"^({_accepts(field.dataType)})$"), F.lit(prefix + field.name))

    found = []
    for field in schema.fields:
        if not isinstance(field.dataType, T.ArrayType):
            found.append(check(value, "", field))
            continue
        whole = kind(value, f"$.{field.name}")
        items = F.try_variant_get(value, f"$.{field.name}", "array<variant>")
        item = F.transform(items, lambda x: _item_fault(x, field, check))
        found.append(F.when(~whole.rlike("^(ARRAY<.*>|VOID)$"), F.lit(field.name)).otherwise(F.get(F.filter(item, lambda f: f.isNotNull()), F.lit(0))))
    return F.when(~F.schema_of_variant(value).rlike("^OBJECT<.*>$"), F.lit("$")).otherwise(F.coalesce(*found))


def _item_fault(item: Column, field: T.StructField, check) -> Column:
    parts = [check(item, f"{field.name}.", part) for part in field.dataType.elementType.fields]
    return F.when(~F.schema_of_variant(item).rlike("^(OBJECT<.*>|VOID)$"), F.lit(field.name)).otherwise(F.coalesce(*parts))


def read_with_rejects(spark: SparkSession, path: str, schema: T.StructType = ARTICLE) -> tuple[DataFrame, DataFrame]:
    """Articles, and ``(value, reason)``: the raw lines that are no article and what is wrong with them.

    The reason is ``not an article`` where a line is no JSON object, else the field with a value of the wrong kind.
    """
    marked = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    lines = spark.read.text(path)
    article = F.from_json("value", marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})

    def reason(article: Column) -> Column:
        late = article[CORRUPT].isNotNull()  # a kind that fits and a value that does not, as a number out of range

        def judged(value: Column, wrong: Column) -> Column:
            broken = article.isNull() | value.isNull() | (wrong == "$")
            return F.when(broken, F.lit("not an article")).when(wrong.isNotNull(), wrong).when(late, F.lit("value out of range"))

        return let(F.try_parse_json("value"), lambda value: let(_wrong_field(value, schema), lambda wrong: judged(value, wrong)))

    # A line is parsed once: a filter would be pushed below the parsing, and repeat it.
    right = let(article, lambda a: F.filter(F.array(a), lambda x: reason(x).isNull()))
    reasons = F.filter(F.array(let(article, reason)), lambda r: r.isNotNull())
    return (
        lines.select(F.explode(right).alias("article")).select(*[f"article.{name}" for name in schema.names]),
        lines.select("value", F.explode(reasons).alias("reason")),
    )


def published_at(millis: Column) -> Column:
    return F.timestamp_millis(millis)
