"""Print the query catalogue as Markdown: python -m cohortlens.plans.catalog > QUERIES.md"""

from __future__ import annotations

from cohortlens.plans.registry import all_queries


def catalog() -> str:
    qs = all_queries()
    lines = ["# Registered queries", "",
             "Generated by `python -m cohortlens.plans.catalog`. `SQL` = value-compared with a DuckDB twin; "
             "`rows-only` = output depends on fitted models (property-tested instead).", "",
             "| query | SURVEY §2 operators | oracle |", "|---|---|---|"]
    for name, q in qs.items():
        lines.append(f"| {name} | {', '.join(q.operators)} | {'SQL' if q.sql else 'rows-only'} |")
    n_sql = sum(1 for q in qs.values() if q.sql)
    lines += ["", f"{len(qs)} queries, {n_sql} with a SQL twin."]
    return "\n".join(lines) + "\n"


if __name__ == "__main__":
    print(catalog(), end="")
