"""Facet filter over the sections of a listing."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The targets asked for in each section of the filter dialog.
SECTION_TARGETS = {
    "sort by": ["most recent"],
    "date posted": ["past month"],
    "experience level": ["entry level", "associate", "mid-senior level"],
    "job type": ["full-time", "part-time", "contract"],
    "remote": ["remote"],
}


def facet_filter(df: DataFrame, sections: dict[str, list[str]]) -> DataFrame:
    """Keep rows whose label is a target, in each section that offers one.

    Labels compare in lower case. Targets nobody offers are skipped, and a
    section that offers none filters nothing. What is offered comes from one
    aggregate over all sections, used as a scalar.
    """
    wanted = {col: F.lower(F.col(col)).isin(targets) for col, targets in sections.items()}
    tests = list(enumerate(wanted.values()))
    offered = [F.coalesce(F.max(test), F.lit(False)).alias(f"s{i}") for i, test in tests]
    offers = df.agg(F.struct(*offered)).scalar()
    kept = F.lit(True)
    for i, test in tests:
        kept = kept & (~offers.getField(f"s{i}") | test)
    return df.where(kept)
