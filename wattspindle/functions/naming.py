"""Names and codes: run files, labels in paths, market zones, payload defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattspindle.constants import ZONE_ALIASES, ZONE_CODES
from wattspindle.functions.timebase import parse_month_name

# Fixed pattern: machine, month, year, optional operation, optional run, as in
# M01_Aug_2019_OP00_000, M01_Aug_2019_OP00 and M01_Aug2019_000.
RUN_NAME = r"^(?:.*/)?([^_/]+)_([A-Za-z]{3})_?(\d{4})(?:_(OP\d+))?(?:_(\d+))?(?:\.[^./]*)?$"
OPERATION_FOLDER = r"/(OP\d+)/"
_MARK = "\u0001"


def file_stem(path: Column | str) -> Column:
    path = F.col(path) if isinstance(path, str) else path
    name = F.element_at(F.split(path, "/"), -1)
    return F.regexp_replace(name, r"\.[^.]*$", "")


def with_run_parts(files: DataFrame, path: str = "path") -> DataFrame:
    """Add the parts of run file names; NULL for parts a name does not carry.

    The name is matched once per row: the match is kept in a helper column that
    all parts read.
    """
    groups = _MARK + _MARK.join(f"${group}" for group in range(1, 6))
    matched = files.withColumn(
        "_parts", F.split(F.regexp_replace(path, RUN_NAME, groups), _MARK)
    )
    named = F.size("_parts") == 6

    def part(group: int) -> Column:
        return F.when(named, F.nullif(F.element_at("_parts", group + 1), F.lit("")))

    folder = F.nullif(F.regexp_extract(path, OPERATION_FOLDER, 1), F.lit(""))
    return matched.select(
        *files.columns,
        part(1).alias("machine_id"),
        part(2).alias("month_name"),
        part(3).alias("year"),
        F.coalesce(part(4), F.when(named, folder)).alias("operation"),
        part(5).alias("run_id"),
        parse_month_name(part(2), part(3)).alias("base_date"),
    )


def label_from_path(path: Column | str) -> Column:
    """1 for a path that says ``bad`` in any case, else 0."""
    path = F.col(path) if isinstance(path, str) else path
    return F.contains(F.lower(path), F.lit("bad")).cast("int")


def label_name(label: Column | str) -> Column:
    label = F.col(label) if isinstance(label, str) else label
    return F.when(label == 1, F.lit("Anomaly")).otherwise(F.lit("Normal"))


def _mapped(code: Column, table: dict[str, str]) -> Column:
    entries = [F.lit(item) for pair in table.items() for item in pair]
    return F.coalesce(F.try_element_at(F.create_map(*entries), code), code)


def market_area(country: Column | str) -> Column:
    """Country code to the market area that is quoted for it."""
    return _mapped(F.col(country) if isinstance(country, str) else country, ZONE_ALIASES)


def zone_code(area: Column | str) -> Column:
    """Market area to its zone identifier; unknown codes pass through."""
    return _mapped(F.col(area) if isinstance(area, str) else area, ZONE_CODES)
