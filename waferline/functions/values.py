"""Value rules: what one process row contributes to a feature."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from waferline.functions.text import clean, clean_dash


def time_and_tool() -> Column:
    tool = F.concat_ws("_", clean("eqp_id"), clean("chamber_id"), clean("unit_id"))
    return F.concat_ws("|", clean("tkout_time"), tool)


def tool() -> Column:
    return F.concat_ws("_", clean_dash("eqp_id"), clean_dash("chamber_id"), clean_dash("unit_id"))


def part_and_reticle() -> Column:
    return F.concat_ws("|", F.substring(clean("part_id"), 1, 10), clean("reticle_id"))


def passed() -> Column:
    return F.when(F.col("tkout_time").isNotNull(), "PASSED").otherwise("NOT_PASSED")


def wafer_order() -> Column:
    """The row's own order, else the rank that ``operators.features.add_wafer_rank`` adds."""
    return F.coalesce(clean_dash("sleuth_order"), F.col("wafer_rank").cast("string"))


def _text(name: str) -> Callable[[], Column]:
    return lambda: F.col(name).cast("string")


VALUES: dict[str, Callable[[], Column]] = {
    "eqp_id": _text("eqp_id"),
    "chamber_id": _text("chamber_id"),
    "unit_id": _text("unit_id"),
    "part_id": lambda: F.substring(F.col("part_id").cast("string"), 1, 10),
    "reticle_id": _text("reticle_id"),
    "ppid": _text("ppid"),
    "tkout_time": _text("tkout_time"),
    "tkout_status": passed,
    "sleuth_order": wafer_order,
    "eqpall": time_and_tool,
    "ecuall": tool,
    "reticleall": part_and_reticle,
}

# Fixed value: this feature always uses this aggregate, whatever its rule says.
FORCED_AGG = {"ecuall": "valid_or_last"}
