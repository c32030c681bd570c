"""Names of measurements, islands and components."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lumitrace.functions.sky import _col


def measurement_name(image_name, component_id) -> Column:
    """Component id with the image's prefix: the text after `.i.` up to the next dot."""
    name = _col(image_name)
    after = F.when(F.instr(name, ".i.") > 0, F.substr(name, F.instr(name, ".i.") + 3)).otherwise(name)
    return F.concat(F.substring_index(after, ".", 1), F.lit("_"), _col(component_id))


def island_number(island_id) -> Column:
    """Number behind the last underscore of an island id."""
    return F.substring_index(_col(island_id), "_", -1).try_cast("long")


def island_prefix(island_id) -> Column:
    """Island id up to and including its last underscore."""
    text = _col(island_id)
    return F.concat(F.regexp_extract(text, r"^(.*)_[^_]*$", 1), F.lit("_"))


def component_of_island(island_id) -> Column:
    """Component id of a single-component island."""
    return F.concat(F.replace(_col(island_id), F.lit("island"), F.lit("component")), F.lit("a"))


def forced_name(component_id, run_id: int) -> Column:
    return F.concat(_col(component_id), F.lit(f"_f_run{run_id:03d}"))


def selection_names(text, prefix: str = "") -> Column:
    """A user's comma list as an array: blanks and the catalogue prefix removed."""
    clean = F.replace(_col(text), F.lit(" "), F.lit(""))
    if prefix:
        clean = F.replace(clean, F.lit(prefix), F.lit(""))
    return F.split(clean, ",")
