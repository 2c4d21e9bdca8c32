"""Oracle SQL per published query name."""

from __future__ import annotations

import oracle.gold  # noqa: F401  (registers CTEs)
import oracle.marts  # noqa: F401
import oracle.loads  # noqa: F401
import oracle.raw  # noqa: F401
from oracle.bind import with_ctes

SPECIAL = {
    "category_revenue": "SELECT * EXCLUDE (gross), CAST(gross AS DOUBLE) AS gross_revenue FROM m_category_revenue",
}


def sql_for(name: str) -> str:
    if name in SPECIAL:
        return with_ctes(SPECIAL[name])
    if name.startswith("silver_"):
        return with_ctes(f"SELECT * FROM s_{name[len('silver_'):]}")
    if name.startswith(("dim_", "fact_")):
        return with_ctes(f"SELECT * FROM g_{name}")
    return with_ctes(f"SELECT * FROM m_{name}")
