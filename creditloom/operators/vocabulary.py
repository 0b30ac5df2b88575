"""Stored vocabularies: they only grow, and a value keeps its place, so that months built by different runs have the same columns.

A version is the whole of all vocabularies, as a numbered file; a run that learns something new writes the next one.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.functions.casts import quoted
from creditloom.operators.encoding import MAX_VOCABULARY, item_column
from creditloom.sources.files import newest, numbered, read_json, write_json
from creditloom.sources.readers import Day, read_snapshots
from creditloom.sources.schemas import SNAPSHOT

#: A flag that every customer with financials has, whatever the vocabulary.
KNOWN = "has_valid_payment_behavior"


def stored_vocabularies(spark: SparkSession, root: str, version: int | None = None) -> dict[str, list[str]]:
    """The vocabularies of a version, by default the last one; none before the first."""
    path = newest(spark, root)[1] if version is None else numbered(root, version)
    return (read_json(spark, path) or {}) if path else {}


def extend_vocabularies(
    spark: SparkSession, root: str, found: Mapping[str, Iterable[str]], limit: int = MAX_VOCABULARY
) -> dict[str, list[str]]:
    """The stored vocabularies with what was found added at their ends, in order, and stored if that is anything.

    Values that are found no more stay. More than `limit` values of one vocabulary are an error, and nothing is stored then. Of two runs
    that extend the same version at once one fails.
    """
    last, _ = newest(spark, root)
    held = stored_vocabularies(spark, root)
    grown = {name: [*held.get(name, []), *sorted(set(found.get(name, [])) - set(held.get(name, [])))] for name in {**held, **found}}
    for name, values in grown.items():
        if len(values) > limit:
            raise ValueError(f"more than {limit} distinct values of {name}; pass the vocabulary")
    if grown != held:
        write_json(spark, numbered(root, last + 1), grown, replace=False)
    return grown


def read_encoded(
    spark: SparkSession, root: str, items: Sequence[str], behaviours: Sequence[str] = (), start: Day = None, end: Day = None
) -> DataFrame:
    """Months of encoded features with the columns of the whole vocabulary, also those built before it had grown.

    What a vocabulary didn't hold yet no row of its month had, so its flags are 0 there: item flags of customers with
    financials, behaviour flags of those whose behaviour is known. Flags stand at the end, in the order of the vocabulary.
    """
    rows = read_snapshots(spark, root, start, end, merge_schema=True)
    flags = {item_column(i): F.col(KNOWN).isNotNull() for i in items}
    flags |= {f"pb_{b}".lower(): F.col(KNOWN) == 1 for b in behaviours}
    value = {c: quoted(c) if c in rows.columns else F.lit(None).cast("int") for c in flags}
    filled = [F.when(value[c].isNull() & known, 0).otherwise(value[c]).alias(c) for c, known in flags.items()]
    rest = [quoted(c) for c in rows.columns if c not in flags and c != SNAPSHOT]
    return rows.select(*rest, *filled, SNAPSHOT)
