"""Text clean-up, free-form header lookup and numeric coercion."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The numeric prefix grammar, white space, and what is dropped from amounts.
NUMERIC_PREFIX = r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)"
WHITE_SPACE = (
    "\t\n\v\f\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)
AMOUNT_NOISE = ",£$€" + WHITE_SPACE

WIDE_DECIMAL = "decimal(38,10)"


def trim_ws(c: Column) -> Column:
    """Trim every Unicode space; Spark's plain ``trim`` only removes U+0020."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def non_blank(c: Column) -> Column:
    return F.nullif(trim_ws(c), F.lit(""))


def slugify(c: Column) -> Column:
    """Runs of characters other than ASCII letters and digits become one dash."""
    return F.lower(F.regexp_replace(c, "[^a-zA-Z0-9]+", "-"))


def numeric_prefix(c: Column) -> Column:
    """Leading number of a text (``12abc`` -> 12) as a wide decimal, else null."""
    # a failing try_cast is slow (it throws inside), so a miss becomes null before it
    return F.nullif(F.regexp_extract(c, NUMERIC_PREFIX, 1), F.lit("")).try_cast(WIDE_DECIMAL)


def report_amount(c: Column) -> Column:
    """Amount cell of a report: thousands commas dropped, blank or non-numeric -> null."""
    return numeric_prefix(F.translate(c, ",", "")).try_cast("decimal(15,2)")


def money_text_to_number(c: Column) -> Column:
    """Amount cell of a bank export: currency signs, commas and spaces dropped."""
    return numeric_prefix(F.translate(c, AMOUNT_NOISE, ""))


def plain_number(c: Column) -> Column:
    """Shortest decimal text: ``100.00`` -> ``100``, ``-42.50`` -> ``-42.5``."""
    return F.regexp_replace(c.cast(WIDE_DECIMAL).cast("string"), r"\.?0+$", "")


def header_entries(raw: Column) -> Column:
    """Entries of an uploaded row as ``array<struct<n, key, name, value>>``.

    Sorted by (key length, key), the order in which a binary JSON column gives keys back;
    it decides between headers that are equal after trimming and lower-casing.
    """
    return F.array_sort(
        F.transform(
            F.map_entries(raw),
            lambda e: F.struct(
                F.octet_length(e["key"]).alias("n"),
                e["key"].alias("key"),
                F.lower(trim_ws(e["key"])).alias("name"),
                e["value"].alias("value"),
            ),
        )
    )


def field_map(entries: Column) -> Column:
    """Header name -> trimmed value (null if blank), first entry of each name."""
    names = F.transform(entries, lambda e: e["name"])
    first = F.filter(entries, lambda e, i: F.array_position(names, e["name"]) == i + 1)
    return F.map_from_entries(F.transform(first, lambda e: F.struct(e["name"], non_blank(e["value"]))))


def pick_field(fields: Column, aliases: tuple[str, ...]) -> Column:
    """First non-blank value of a :func:`field_map` among ``aliases``, in priority order."""
    return F.coalesce(*[F.try_element_at(fields, F.lit(alias.lower())) for alias in aliases])


def row_json(entries: Column) -> Column:
    """Compact JSON text of an uploaded row, keys in :func:`header_entries` order."""
    pairs = F.transform(entries, lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))
    return F.to_json(F.map_from_entries(pairs))
