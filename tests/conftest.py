import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

from postloom.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def values(spark):
    """Evaluate a column function over literal inputs, in order."""

    def run(function, inputs, kind="string"):
        rows = [(i, v) for i, v in enumerate(inputs)]
        df = spark.createDataFrame(rows, f"i int, v {kind}")
        out = df.select("i", function("v").alias("out")).collect()
        return [r["out"] for r in sorted(out, key=lambda r: r["i"])]

    return run


def rows_read(df):
    """Rows that the scans of a computed DataFrame gave."""
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "Adaptive" in plan.nodeName() else plan

    def leaves(node):
        if "QueryStage" in node.nodeName():
            yield from leaves(node.plan())
        elif node.children().size():
            for i in range(node.children().size()):
                yield from leaves(node.children().apply(i))
        else:
            yield node

    return sum(n.metrics().get("numOutputRows").get().value() for n in leaves(plan) if n.nodeName().startswith("Scan"))
