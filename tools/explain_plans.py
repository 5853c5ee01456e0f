"""Print the physical plans of the job's stages (``explain("formatted")``
trimmed to the operator tree plus scan schemas) for the plan review in
PLANS.md. Usage: python tools/explain_plans.py [sf_dir]"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fairgauge.operators import results as R  # noqa: E402
from fairgauge.plans import fixtures as X  # noqa: E402
from fairgauge.plans import queries as Q  # noqa: E402
from fairgauge.plans.evaluate import REQUEST_COLUMNS, results  # noqa: E402
from fairgauge.session import local_session  # noqa: E402


def tree(df) -> str:
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    head, _, details = text.partition("\n\n\n")
    scans = sorted(set(re.findall(r"ReadSchema: (struct<[^\n]*>)", details)))
    pushed = sorted(set(re.findall(r"PushedFilters: (\[[^\n]*\])", details)))
    return head.strip() + "\n\nReadSchema:\n  " + "\n  ".join(scans) + "\nPushedFilters:\n  " + "\n  ".join(pushed)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 8)
    out = tempfile.mkdtemp(prefix="fairgauge-plans-", dir=os.environ.get("BENCH_SCRATCH"))
    reqs = Q.request_table(spark, sf).select(*REQUEST_COLUMNS)
    print("## requests\n" + tree(reqs))
    reqs.write.parquet(f"{out}/requests")
    written = spark.read.parquet(f"{out}/requests")
    X.reply_stub(written).write.parquet(f"{out}/replies")
    res = results(written, spark.read.parquet(f"{out}/replies"))
    print("\n## results\n" + tree(res))
    res.write.parquet(f"{out}/results")
    u = spark.read.parquet(f"{out}/results")
    print("\n## strategy_summary\n" + tree(R.strategy_summary(u)))
    print("\n## dataset_ranking\n" + tree(R.dataset_ranking(u)))


if __name__ == "__main__":
    main()
