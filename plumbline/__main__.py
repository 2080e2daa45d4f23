"""The command line: python -m plumbline 'SQL' prints a query's packets as JSON lines; without SQL it reads statements.

At the prompt, \\load FILE INTO TABLE appends a file of JSON lines, and \\q ends.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Callable, Iterable, Iterator
from typing import Any

from .session import Engine, QueryError


def packets(engine: Engine, sql: str) -> Iterator[dict[str, Any]]:
    """What a statement gives: its columns, its rows, totals and extremes if any, and its progress."""
    try:
        result = engine.query(sql)
        yield {"type": "header", "query_id": result.query_id, "columns": [[f.name, f.dataType.simpleString()] for f in result.data.schema.fields]}
        for row in result.objects(big_as_text=True):
            yield {"type": "row", "row": row}
        if result.totals is not None:
            yield {"type": "totals", "row": result.totals.first().asDict(recursive=True)}
        if str(result.settings.get("extremes", "0")) in ("1", "true"):
            yield {"type": "extremes", "rows": [r.asDict(recursive=True) for r in result.extremes.collect()]}
        p = result.progress
        yield {"type": "progress", "read_rows": p.read_rows, "result_rows": p.result_rows, "percent": p.percent, "elapsed_s": round(p.elapsed_s, 3)}
    except QueryError as e:
        yield {"type": "exception", "condition": e.condition, "state": e.state, "message": str(e).splitlines()[0]}


def run(engine: Engine, statements: Iterable[str], out: Callable[[str], Any] = print) -> int:
    """Runs statements and prints their packets; the number of failed ones."""
    failed = 0
    for text in statements:
        text = text.strip().rstrip(";")
        if text == "\\q":
            break
        if m := re.fullmatch(r"\\load\s+(\S+)\s+INTO\s+([\w.]+)", text, re.I):
            engine.load_json_lines(m[1], m[2])
            out(json.dumps({"type": "loaded", "table": m[2]}))
        elif text:
            for packet in packets(engine, text):
                failed += packet["type"] == "exception"
                out(json.dumps(packet, default=str))
    return failed


def main(args: list[str]) -> int:
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return int(run(Engine(spark), args or sys.stdin) > 0)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
