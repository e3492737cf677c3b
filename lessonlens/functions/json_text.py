"""JSON text columns (H15, H18): validity, and arrays of objects with a declared schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS, CORRUPT = "rows", "corrupt"


def json_valid(text: Column | str) -> Column:
    """1 for well-formed JSON text (one value), 0 for any other, NULL for NULL.

    The parser stops after the first value, so the text is parsed inside an array and inside an object, with
    a mark behind it: the mark is where it should be only if the text is one value."""
    c = F.col(text) if isinstance(text, str) else text
    listed = F.try_parse_json(F.concat(F.lit("["), c, F.lit(',"end"]')))
    named = F.try_parse_json(F.concat(F.lit('{"value":'), c, F.lit(',"end":1}')))

    def at(v: Column, path: str) -> Column:
        return F.try_variant_get(v, path, "variant").isNotNull()

    one = (at(listed, "$[0]") & (F.try_variant_get(listed, "$[1]", "string") == "end") & ~at(listed, "$[2]")
           & at(named, "$.value") & at(named, "$.end"))
    return F.when(c.isNotNull(), F.when(F.coalesce(one, F.lit(False)), 1).otherwise(0)).cast("int")


def parsed(text: Column | str, element: str) -> Column:
    """A struct of ``rows`` (array of the declared ``element``, e.g. ``"struct<id:bigint,name:string>"``) and
    ``corrupt`` (the text, if it is malformed or not an array of such objects).  Fields that the
    text lacks are NULL; undeclared ones are not read.  NULL text gives NULL in both."""
    c = F.col(text) if isinstance(text, str) else text
    # only an object can carry the record that did not parse
    wrapped = F.concat(F.lit('{"' + ROWS + '":'), c, F.lit("}"))
    got = F.from_json(wrapped, f"{ROWS} array<{element}>, {CORRUPT} string",
                      {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    bad = got[CORRUPT].isNotNull() | (json_valid(c) == 0) | (F.substring(F.ltrim(c), 1, 1) != "[")
    return F.struct(F.when(~bad, got[ROWS]).alias(ROWS), F.when(bad, c).alias(CORRUPT))


def inline_json(df: DataFrame, text: str, element: str, *keep: str) -> tuple[DataFrame, DataFrame]:
    """(one row per object of the column ``text`` with the columns ``keep``, the rows that did not parse)."""
    read = df.withColumn("_parsed", parsed(text, element))
    good = read.where(F.col(f"_parsed.{ROWS}").isNotNull()).select(*keep, F.inline(f"_parsed.{ROWS}"))
    return good, read.where(F.col(f"_parsed.{CORRUPT}").isNotNull()).drop("_parsed")
