"""The business codes that results depend on, and the keyword source weights."""

APPRAISE = {"good": "1201", "fair": "1202", "bad": "1203", "auto": "1204"}

KEYWORD_WEIGHT = {"SEARCH": 10, "ORDER": 3, "CART": 2, "CLICK": 1}
