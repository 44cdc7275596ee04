"""The rule tables of the registered queries: configuration, not data."""

from __future__ import annotations

VEHICLES = ("VH_O", "VH_F")
PRODUCTS = {"VH_O": "P_ALPHA", "VH_F": "P_BETA"}
LOT_PREFIX = "R"
TODAY = "2024-02-01"

_STEPS = [
    ("CC900000", "WELL_IMPLANT"),
    ("CC901000", "GATE_STACK"),
    ("CC902000", "GATE_ETCH"),
    ("CC903000", "SPACER_CVD"),
    ("CC904000", "CONTACT_ETCH"),
    ("CC906000", "METAL_ETCH"),
    ("CC907000", "METAL_ETCH"),
    ("CC909000", "GATE_PHOTO"),
    ("CC912000", "FINAL_INSPECTION"),
]
_STEP_ROWS = [(v, PRODUCTS[v], s, d) for v in VEHICLES for s, d in _STEPS if (v, s) != ("VH_F", "CC904000")]

_FAB = [
    ("GATE_ETCH", "eqp_id", "last_valid"),
    ("GATE_ETCH", "ecuall", "last"),
    ("SPACER_CVD", "eqp_id", "first"),
    ("SPACER_CVD", "eqpall", "concat"),
    ("CONTACT_ETCH", "tkout_status", "last"),
    ("METAL_ETCH", "ppid", "agg"),
    ("METAL_ETCH", "sleuth_order", "last"),
    ("WELL_IMPLANT", "reticleall", "last"),
    ("GATE_STACK", "eqp_id", "valid_eqp"),
    ("GATE_STACK", "part_id", "first"),
    ("NO_SUCH_STEP", "eqp_id", "first"),
    ("GATE_ETCH", "mystery", "last"),
    ("FINAL_INSPECTION", "tkout_time", "last"),
]

_KNOB = [
    ("GATE_ETCH", "GATE_ETCH", "R1", "eq", "PP_A0", "KNOB_A", None, None),
    ("GATE_ETCH", "GATE_ETCH", "R2", "eq", "PP_N1", "KNOB_B", "Y", None),
    ("GATE_ETCH", "GATE_ETCH", "R3", "eq", "PP_N1", "KNOB_LATE", None, None),
    ("GATE_ETCH", "GATE_ETCH", "RO", None, None, None, None, None),
    ("METAL_ETCH", "METAL_ETCH", "R1", "eq", "PP_R0", "KNOB_M1", None, "last_valid"),
    ("METAL_ETCH", "METAL_ETCH", "R2", "eq", "PP_A1", "KNOB_M2", "N", None),
    ("METAL_ETCH", "METAL_ETCH", "RO", None, None, None, None, None),
    ("FINAL", "FINAL_INSPECTION", "R1", "eq", "PP_A0", "KNOB_F", None, None),
    ("FINAL", "FINAL_INSPECTION", "R9", "_null", None, "SKIP", None, None),
    ("FINAL", "GATE_PHOTO", "R9", "not_null", None, "SKIP", None, None),
    ("CONTACT", "CONTACT_ETCH", "R1", "eq", "PP_R1", "KNOB_C", None, None),
    ("CONTACT", "NO_SUCH_STEP", "R5", "not_null", None, "SKIP", None, None),
    ("WELL", "WELL_IMPLANT", "R1", "eq", "PP_A0", "KNOB_W", None, None),
    ("WELL", "WELL_IMPLANT", "R2", "eq", "PP_A0", "KNOB_AND", None, None),
    ("WELL", "GATE_STACK", "R2", "eq", "PP_N0", "KNOB_AND", None, None),
]

_PAIRS = [
    ("VH_O", "CC902000", "GATE_ETCH", "PP_A0", "KNOB_OLD", None),
    ("VH_O", "CC902000", "GATE_ETCH", "PP_A0", "KNOB_A", None),
    ("VH_O", "CC904000", "CONTACT_ETCH", "PP_R1", "KNOB_STD", "last_valid"),
    ("VH_F", "CC902000", "GATE_ETCH", "PP_N0", "KNOB_B", None),
    ("VH_F", "CC906000", "METAL_ETCH", "PP_R0", "KNOB_M1", None),
]


def _numbered(rows: list[tuple]) -> list[tuple]:
    return [(*row, i) for i, row in enumerate(rows)]


BOOK: dict[str, tuple[list[str], list[tuple]]] = {
    "step_map": (["vehicle", "product", "step_id", "step_desc"], _STEP_ROWS),
    "products": (["vehicle", "product_name"], list(PRODUCTS.items())),
    "fab_rules": (["step_desc", "feature_name", "agg"], _FAB),
    "knob_rules": (
        ["feature_name", "function_step", "rule_order", "operator", "value", "category", "use", "agg", "pos"],
        _numbered(_KNOB),
    ),
    "knob_pairs": (["vehicle", "step_id", "step_desc", "ppid", "knob", "agg", "pos"], _numbered(_PAIRS)),
    "mask_rules": (["step_desc", "agg"], [("GATE_PHOTO", "first"), ("WELL_IMPLANT", "last_valid")]),
    "mask_categories": (
        ["reticle_id", "category"],
        [(f"RT{i:03d}", f"MASKSET_{i % 4}") for i in range(0, 50, 3)],
    ),
    "inline_rules": (
        ["item_id", "agg"],
        [("click", "mean"), ("view", "last"), ("purchase", "max"), ("error", "first"), ("nothing", "mean")],
    ),
    "vm_rules": (
        ["sensor_id", "agg"],
        [("view", "mean"), ("purchase", "max"), ("signup", "min"), ("error", "first")],
    ),
    "item_rules": (
        ["step_desc", "item_id"],
        [("STEP_0", "click"), ("STEP_1", "view"), ("STEP_2", "purchase"), ("STEP_2", "click")],
    ),
    "ignored": (
        ["type", "key", "reason"],
        [("step", "AX550000", "side clean"), ("ppid", "CC902000:PP_R0", "test recipe")],
    ),
}

# rules of the matrix engine: (feature, step, order, operator, value, category)
ENGINE = [
    ("OXIDE", "GATE_ETCH", "R2", "eq", "PP_A0", "PC_A"),
    ("OXIDE", "SPACER_CVD", "R2", "not_null", None, "PC_A"),
    ("OXIDE", "GATE_ETCH", "R1", "in", "PP_N0|PP_N1", "PC_N"),
    ("OXIDE", "GATE_ETCH", "RO", None, None, None),
    ("OXIDE", "SPACER_CVD", "RO", None, None, None),
    ("WELL", "WELL_IMPLANT", "R1", "contains", "^PP_R", "WELL_R"),
    ("WELL", "WELL_IMPLANT", "R10", "neq", "PP_A0", "WELL_OTHER"),
    ("WELL", None, "RO", None, None, "WELL_STD"),
    ("COMBO", "OXIDE", "R1", "eq", "PC_N", "COMBO_N"),
    ("COMBO", "WELL", "R2", "not_in", "WELL_STD|WELL_R", "COMBO_W"),
    ("COMBO", "NO_SUCH_STEP", "R3", "_null", None, "COMBO_X"),
    ("COMBO", "GATE_STACK", "R4", "_null", None, "COMBO_0"),
]
ENGINE_COLUMNS = ["feature_name", "step_desc", "rule_order", "operator", "value", "category"]


def dicts(name: str) -> list[dict]:
    columns, rows = BOOK[name]
    return [dict(zip(columns, row)) for row in rows]


def engine_rules() -> list[dict]:
    return [dict(zip(ENGINE_COLUMNS, row)) for row in ENGINE]
