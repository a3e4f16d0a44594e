"""Write PLANS.md: the physical operator tree of each headline query
(``explain("formatted")``, AQE off so the static plan is shown) plus the
scan's pushed filters and read schema.

    python scripts/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from corpusmill.plans.queries import QUERIES  # noqa: E402
from corpusmill.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `scripts/dump_plans.py` on `{os.path.basename(sf_dir)}` with AQE off (static plan; "
           "at run time AQE may still switch a sort-merge join to broadcast or coalesce partitions). "
           "Only the operator tree and the scans' pushed filters / read schema are kept.", ""]
    for name in HEADLINE:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            QUERIES[name](spark, sf_dir).explain("formatted")
        text = re.sub(r"#\d+", "", buf.getvalue())
        tree, _, details = text.partition("\n\n\n")
        scans = [ln.strip() for ln in details.split("\n")
                 if ln.startswith(("PushedFilters", "ReadSchema"))]
        out += [f"## {name}", "", "```", tree.strip(), *(["", *scans] if scans else []), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
