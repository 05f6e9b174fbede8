"""Golden workbooks built cell by cell (the reference's fixture files are not
in its checkout; these reproduce the values its tests assert)."""

from tessera import template as tpl


def _kv_rows(values: dict) -> list:
    labels = tpl.get_template()["sections"]["evaluations_metadata"]["key_value"]
    cells = []
    for i, lab in enumerate(labels):
        r = 3 + i
        cells.append((r, 2, "string", lab))
        if lab in values and values[lab] is not None:
            v = values[lab]
            cells.append((r, 3, "number" if isinstance(v, float) else "string", str(v)))
    return cells


BASE = {
    "Rated entity": "Company A", "CorporateSector": "Personal & Household Goods",
    "Segmentation criteria": "EBITDA", "Reporting Currency/Units": "EUR",
    "Country of origin": "Federal Republic of Germany", "Accounting principles": "IFRS",
    "End of business year": "December", "Business risk profile": "B+",
    "(Blended) Industry risk profile": "A", "Competitive Positioning": "BBB", "Market share": "BBB",
    "Diversification": "BB", "Operating profitability": "BBB",
    "Sector/company-specific factors (1)": "BBB", "Financial risk profile": "C",
    "Leverage": "B", "Interest cover": "A", "Cash flow cover": "B", "Liquidity": "-2 notches",
}


def company_a(extra=None, drop=()) -> dict:
    values = {k: v for k, v in BASE.items() if k not in drop}
    cells = _kv_rows(values)
    cells += [(23, 2, "string", "Rating methodologies applied"),
              (23, 3, "string", "General Corporate Rating Methodology"),
              (23, 4, "string", "Consumer Products Rating Methodology"),
              (24, 2, "string", "Industry risk"), (24, 3, "string", "Consumer Products: Non-Discretionary"),
              (25, 2, "string", "Industry risk score"), (25, 3, "string", "A"),
              (26, 2, "string", "Industry weight"), (26, 3, "number", "1.0")]
    cells += [(35, 2, "string", "[Scope Credit Metrics]"), (35, 3, "number", "2024"), (35, 4, "string", "2025E")]
    metric_labels = ["Scope-adjusted EBITDA interest cover", "Scope-adjusted debt/EBITDA", "Scope-adjusted FFO/debt",
                     "Scope-adjusted loan/value", "Scope-adjusted FOCF/debt", "Liquidity"]
    for i, lab in enumerate(metric_labels):
        cells.append((36 + i, 2, "string", lab))
        cells.append((36 + i, 3, "number", "36.79999999999997" if i == 0 else "1.5"))
        cells.append((36 + i, 4, "number", "36.79999999999997" if i == 0 else "1e-05"))
    for r in range(35, 42):
        cells.append((r, 13, "string", "Locked"))
    cells += list(extra or [])
    return {"MASTER": cells}


def company_b() -> dict:
    wb = company_a()
    cells = [c for c in wb["MASTER"] if c[0] not in (3, 4, 24, 25, 26) or c[1] == 2]
    cells += [(3, 3, "string", "Company B"), (4, 3, "string", "Automobiles & Parts"),
              (24, 3, "string", "Automotive Suppliers"),
              (24, 4, "string", "Automotive and Commercial Vehicle Manufacturers"),
              (25, 3, "string", "BBB"), (25, 4, "string", "BB"),
              (26, 3, "number", "0.15"), (26, 4, "number", "0.85")]
    return {"MASTER": cells}
