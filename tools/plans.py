"""Print the physical plans of the headline queries as Markdown.

    python tools/plans.py [sf_dir] > PLANS.md

Each plan is the one Spark chooses before adaptive re-planning, built the
way the registered query builds it (reports over the written spine table).
Long expression lists are shortened so the operator tree stays readable.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

HEADLINE = ("spine", "spine_sorted", "coverage", "group_filter", "group_coverage", "abx_level4",
            "report_cube", "ddd_lookup", "page_of_table", "xml_bnf_records")


def _shorten(line: str, width: int = 160) -> str:
    line = re.sub(r"#\d+L?", "", line)
    return line if len(line) <= width else line[: width - 3] + "..."


def main(argv: list[str]) -> None:
    from rxcover.functions.text import WHITESPACE
    from rxcover.plans.queries import QUERIES
    from rxcover.session import local_session

    sf = argv[0] if argv else "/root/testdata/sf0.1"
    spark = local_session()
    print("# Physical plans of the headline queries\n")
    print(f"Generated by `tools/plans.py` on `{os.path.basename(sf.rstrip('/'))}`, local[8], AQE on "
          "(initial plans; AQE may coalesce partitions or switch joins at run time). Expression lists are cut "
          "at 160 characters; `<whitespace>` stands for the 29-character trim set.\n")
    for name in HEADLINE:
        df = QUERIES[name](spark, sf)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        text = buf.getvalue().replace(WHITESPACE, "<whitespace>")
        lines = [_shorten(x) for x in text.split("\n") if x.strip()]
        print(f"## `{name}`\n\n```\n" + "\n".join(lines) + "\n```\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
