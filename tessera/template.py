"""Template contract for incoming rating workbooks and its fingerprint.

The template is configuration, not data: a handful of sections with A1
ranges and label lists. It is turned into small DataFrames (one row per
section, label or ignored range) that are broadcast into the extraction
joins; their size is fixed by the template, not by the data.
"""

from __future__ import annotations

import hashlib
import json
import re

# ---------------------------------------------------------------------------
# They must equal the contract the workbooks are written
# against (sheet name, section ranges, labels, optional keys, ignored text).
# ---------------------------------------------------------------------------
TEMPLATES = {
    "corporate_credit_rating": {
        "v1": {
            "schema_type": "corporate_credit_rating",
            "schema_version": "v1",
            "sheet_name": "MASTER",
            "sections": {
                "evaluations_metadata": {
                    "range": "C1:I34",
                    "key_value": [
                        "Rated entity",
                        "CorporateSector",
                        "Segmentation criteria",
                        "Reporting Currency/Units",
                        "Country of origin",
                        "Accounting principles",
                        "End of business year",
                        "Business risk profile",
                        "(Blended) Industry risk profile",
                        "Competitive Positioning",
                        "Market share",
                        "Diversification",
                        "Operating profitability",
                        "Sector/company-specific factors (1)",
                        "Sector/company-specific factors (2)",
                        "Financial risk profile",
                        "Leverage",
                        "Interest cover",
                        "Cash flow cover",
                        "Liquidity",
                    ],
                    "named_list": [
                        "Rating methodologies applied",
                        "Industry risk",
                        "Industry risk score",
                        "Industry weight",
                    ],
                    "optional_keys": [
                        "Sector/company-specific factors (2)",
                    ],
                },
                "credit_metrics": {
                    "range": "C35:M41",
                    "ignored_cell_values": {"Locked": "M35:M41"},
                    "key_value": [],
                    "named_list": [
                        "[Scope Credit Metrics]",
                        "Scope-adjusted EBITDA interest cover",
                        "Scope-adjusted debt/EBITDA",
                        "Scope-adjusted FFO/debt",
                        "Scope-adjusted loan/value",
                        "Scope-adjusted FOCF/debt",
                        "Liquidity",
                    ],
                },
            },
        }
    }
}

DEFAULT_TYPE = "corporate_credit_rating"
DEFAULT_VERSION = "v1"
# Label of the row that carries the year header of the metrics block.
YEAR_HEADER = "[Scope Credit Metrics]"
# Column B holds the row labels.
LABEL_COL = 2
# ---------------------------------------------------------------------------


def get_template(schema_type: str = DEFAULT_TYPE, version: str = DEFAULT_VERSION) -> dict:
    return TEMPLATES[schema_type][version]


def template_sha(template: dict) -> str:
    """SHA-256 of the key-sorted JSON text of a template."""
    return hashlib.sha256(json.dumps(template, sort_keys=True).encode("utf-8")).hexdigest()


def code_sha(*modules) -> str:
    """SHA-256 over the source bytes of the modules that do the parsing."""
    h = hashlib.sha256()
    for m in modules:
        with open(m.__file__, "rb") as f:
            h.update(f.read())
    return h.hexdigest()


_A1 = re.compile(r"^([A-Z]*)(\d*)$")


def _col_number(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - ord("A") + 1)
    return n


def col_letters(n: int) -> str:
    s = ""
    while n > 0:
        n, r = divmod(n - 1, 26)
        s = chr(ord("A") + r) + s
    return s


def range_bounds(a1: str) -> tuple:
    """``"C1:I34"`` -> (min_col, min_row, max_col, max_row); open ends -> None."""
    parts = a1.upper().split(":")
    if len(parts) == 1:
        parts = parts * 2
    if len(parts) != 2:
        raise ValueError(f"bad range {a1!r}")
    out = []
    for p in parts:
        m = _A1.match(p)
        if not m or (not m.group(1) and not m.group(2)):
            raise ValueError(f"bad range {a1!r}")
        out.append((_col_number(m.group(1)) if m.group(1) else None,
                    int(m.group(2)) if m.group(2) else None))
    (c1, r1), (c2, r2) = out
    return c1, r1, c2, r2


def lint_template(t: dict) -> list[str]:
    """Structural checks of a template (empty list = valid)."""
    problems = []
    if not t.get("sheet_name"):
        problems.append("missing sheet_name")
    sections = t.get("sections") or {}
    if not sections:
        problems.append("no sections")
    for name, cfg in sections.items():
        try:
            c1, r1, c2, r2 = range_bounds(cfg.get("range", ""))
        except ValueError as e:
            problems.append(f"{name}: {e}")
            continue
        if c1 and c2 and c1 > c2 or r1 and r2 and r1 > r2:
            problems.append(f"{name}: min greater than max")
        if not (cfg.get("key_value") or cfg.get("named_list")):
            problems.append(f"{name}: no labels")
        for lab in list(cfg.get("key_value", [])) + list(cfg.get("named_list", [])):
            if not isinstance(lab, str) or not lab.strip():
                problems.append(f"{name}: empty label")
        for k in cfg.get("optional_keys", []):
            if k not in cfg.get("key_value", []):
                problems.append(f"{name}: optional key {k!r} is not a key_value label")
        for text, rng in (cfg.get("ignored_cell_values") or {}).items():
            try:
                range_bounds(rng)
            except ValueError as e:
                problems.append(f"{name}: ignored {text!r}: {e}")
    return problems
