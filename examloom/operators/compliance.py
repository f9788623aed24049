"""Whether a document names part 309 of the rules in the required wording, at its first mention."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from examloom.functions.pyre import pyre

_REQUIRED = r"^(?:.*\s)?PART 309 OF (?:THE )?(?:FDIC|FEDERAL DEPOSIT INSURANCE CORPORATION)"


def part_309(docs: DataFrame, key: str = "doc_id", text: str = "text", before: int = 3, after: int = 10) -> DataFrame:
    """(key, context, has_part_309): the words around the first "part 309", in capitals; an empty context without one.

    Only texts in which the two words stand together are cut into words.
    """
    near = F.col(text).rlike(pyre(r"part\s+309", True, match=False))
    words = F.transform(F.regexp_extract_all(F.col(text), F.lit(pyre(r"([\w']+|[^\w\s])", match=False)), F.lit(1)), F.upper)
    cut = docs.where(near).select(key, F.explode(F.array(words)).alias("w"))  # a generator, as filters would copy the words into every use
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - 1, F.lit(1))), lambda i: F.concat_ws(" ", F.get("w", i - 1), F.get("w", i)))
    at = F.array_position(pairs, "PART 309").cast("int")
    low = F.greatest(at - before, F.lit(1))
    context = F.when(at > 0, F.array_join(F.slice("w", low, F.least(at + after, F.size("w") + 1) - low), " ")).otherwise("")
    found = cut.select(key, context.alias("context"))
    rest = docs.where(~F.coalesce(near, F.lit(False))).select(key, F.lit("").alias("context"))
    return found.unionByName(rest).withColumn("has_part_309", F.col("context").rlike(_REQUIRED))


def without_part_309(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents without the wording."""
    return part_309(docs, key, text).where("NOT has_part_309").select(key)


def exceptions(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, reason) of the documents that a final table should be looked at for: no text, or none of the required wording."""
    found = part_309(docs, key, text).join(docs.select(key, F.coalesce(F.trim(text), F.lit("")).eqNullSafe("").alias("empty")), key)
    return found.where("NOT has_part_309").select(key, F.when(F.col("empty"), "no text").otherwise("no required wording").alias("reason"))
