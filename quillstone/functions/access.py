"""Access control as expressions: sensitivity ranks, clearance, departments. All of it fails closed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Labels from least to most sensitive; departments; those that everyone sees.
SENSITIVITY = ["Public", "Internal", "Confidential", "Restricted"]
DEPARTMENTS = ["HR", "Finance", "Legal", "IT", "General"]
ALL = "All"


def rank(label: Column) -> Column:
    """0 to 3; unknown and null labels count as Restricted."""
    out = F.when(label == SENSITIVITY[0], 0)
    for i, name in enumerate(SENSITIVITY[1:], 1):
        out = out.when(label == name, i)
    return out.otherwise(3)


def clearance_rank(clearance: str | None) -> int:
    """Unknown clearances see Public alone."""
    return SENSITIVITY.index(clearance) if clearance in SENSITIVITY else 0


def is_allowed(label: Column, clearance: str | None) -> Column:
    return rank(label) <= clearance_rank(clearance)


def allowed_labels(clearance: str | None) -> list[str]:
    return SENSITIVITY[: clearance_rank(clearance) + 1]


def department_visible(department: Column, departments: list[str] | str | None) -> Column:
    """Shared rows (General, empty, null) are visible to all; others to members of the department."""
    if departments == ALL or departments and ALL in departments:
        return F.lit(True)
    mine = [departments] if isinstance(departments, str) else list(departments or [])
    return department.isNull() | department.isin("", "General", *mine)


def parse_departments(raw: str) -> list[str] | str:
    return ALL if raw.strip().lower() == "all" else [x.strip() for x in raw.split(",") if x.strip()]


def department_table(department: str) -> str:
    if department not in DEPARTMENTS:
        raise ValueError(f"unknown department: {department!r}")
    return f"rag_chunks_{department.lower()}"


def department_tables(departments: list[str] | str) -> list[str]:
    """Tables of all departments, or of the given known ones and General, each once in order."""
    if departments == ALL or ALL in departments:
        return [department_table(d) for d in sorted(DEPARTMENTS)]
    mine = [departments] if isinstance(departments, str) else list(departments)
    return [department_table(d) for d in dict.fromkeys([*mine, "General"]) if d in DEPARTMENTS]


def label_of(value: Column) -> Column:
    """The label of a rank."""
    return F.get(F.array(*map(F.lit, SENSITIVITY)), value)


def max_sensitivity(label: Column) -> Column:
    """Aggregate: the most sensitive label; Public without rows."""
    return label_of(F.coalesce(F.max(rank(label)), F.lit(0)))


def visible_history(turn_label: Column, clearance: str | None) -> Column:
    """Untagged turns are visible at Restricted only."""
    return is_allowed(turn_label, clearance)
