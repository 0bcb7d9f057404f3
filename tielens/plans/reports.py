"""Text of reports: tables, histograms, digests. Made on the driver from results of bounded size."""

from __future__ import annotations

from pyspark.sql import DataFrame


def table(df: DataFrame, most: int = 50) -> str:
    rows = [["" if v is None else str(v) for v in r] for r in df.limit(most).collect()]
    widths = [max(map(len, c)) for c in zip(df.columns, *rows, strict=True)]
    line = lambda cells: " | ".join(c.ljust(w) for c, w in zip(cells, widths, strict=True)).rstrip()
    return "\n".join([line(df.columns), "-+-".join("-" * w for w in widths), *map(line, rows)])


def histogram(buckets: dict[int, int], width: int = 30) -> str:
    most = max(buckets.values(), default=0) or 1
    return "\n".join(f"{10 * b:>3} {'█' * round(width * buckets.get(b, 0) / most)} {buckets.get(b, 0)}" for b in range(11))


def digest(run_id: str, kind: str, items: list[tuple[int, str, str]]) -> str:
    head = {"failure": "no rows were read", "all_clear": "nothing to decide"}.get(kind, f"{len(items)} to decide")
    return "\n".join([f"{run_id}: {head}", *(f"{n}. {who} — {what}" for n, who, what in items)])


def exit_code(failed: int, inconclusive: int) -> int:
    return 1 if failed else 2 if inconclusive else 0
