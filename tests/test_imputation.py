import statistics
from collections import Counter

import pytest

from furrow.operators.imputation import Level, fill_values

LEVELS = (Level("fine", ("g", "day"), 3), Level("coarse", ("g",)))


@pytest.mark.parametrize("most", [200_000, 0])
@pytest.mark.parametrize("kind", ["median", "mode"])
def test_finest_level_with_support(spark, most, kind):
    known = [("a", d % 3, float(d * d % 7)) for d in range(30)] + [("b", 0, 5.0), ("b", 1, 7.0), (None, 0, 9.0), ("a", None, 2.0), ("c", 0, None)] + [("hot", 0, float(i % 11)) for i in range(400)]
    want = {}
    for name, keys in (("fine", 2), ("coarse", 1)):
        groups = {}
        for *k, v in known:
            if v is not None and None not in k[:keys]:
                groups.setdefault(tuple(k[:keys]), []).append(v)
        for k, v in groups.items():
            if len(v) >= (3 if name == "fine" else 1):
                top = Counter(v).most_common(1)[0][1]
                want[name, k] = (statistics.median(v) if kind == "median" else min(x for x, c in Counter(v).items() if c == top), name, len(v))
    targets = [(i, g, d, "kept") for i, (g, d) in enumerate([("a", 0), ("a", 9), ("b", 0), ("c", 0), (None, 0), ("a", None), ("hot", 0), ("hot", 0)])]
    df = spark.createDataFrame(targets, "id int, g string, day int, v string")
    got = {r.id: (r.value, r.level, r.support) for r in fill_values(df, spark.createDataFrame(known, "g string, day int, value double"), "value", LEVELS, kind, most_broadcast=most).collect()}
    assert len(got) == len(targets)
    for i, g, d, _ in targets:
        assert got[i] == want.get(("fine", (g, d))) or got[i] == want.get(("coarse", (g,)), (None, None, None)) and ("fine", (g, d)) not in want
    assert fill_values(df.limit(0), spark.createDataFrame(known, "g string, day int, value double"), "value", LEVELS, kind).count() == 0


def test_levels_sent_to_every_task_share_a_budget_of_bytes(spark):
    known = spark.range(60_000).selectExpr("concat('group ', id) AS g", "cast(id % 7 AS int) AS day", "cast(id AS double) AS value")
    targets = spark.createDataFrame([(0, "group 59999", 2), (1, "group 59999", 9), (2, "none", 2)], "id int, g string, day int")
    made = fill_values(targets, known, "value", (Level("fine", ("g", "day")), Level("coarse", ("g",)), Level("day", ("day",))))
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") == 1 and plan.count("strategy=merge") == 2  # seven groups; of the others 60,000 each
    assert made._jdf.queryExecution().sparkPlan().toString().count("BroadcastHashJoin") == 1
    assert {r.id: (r.value, r.level) for r in made.collect()} == {0: (59999.0, "fine"), 1: (59999.0, "coarse"), 2: (30000.5, "day")}
