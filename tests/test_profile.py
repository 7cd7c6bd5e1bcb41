"""attach_date_profile against a direct count over every (query, event) pair."""

import datetime as dt
import random

import pytest

from settlekit.operators.profile import ProfileSpec, attach_date_profile

BASE = dt.date(2020, 1, 1)


def _case(seed):
    rnd = random.Random(seed)

    def day():
        return None if rnd.random() < 0.1 else BASE + dt.timedelta(days=rnd.randint(0, 40))

    events = [(rnd.choice([1, 2, 3, None]), day(), day(), rnd.randint(1, 5)) for _ in range(60)]
    queries = [(rnd.choice([1, 2, 3, 4, None]), day(), day(), i) for i in range(25)]
    return events, queries


@pytest.mark.parametrize("seed", range(3))
def test_profile_matches_brute_force(spark, seed):
    events, queries = _case(seed)
    ev = spark.createDataFrame(events, "k int, ed1 date, ed2 date, v bigint")
    qs = spark.createDataFrame(queries, "k int, qd1 date, qd2 date, qid int")
    specs = [ProfileSpec("a", "ed1", "qd1", ("v",)), ProfileSpec("b", "ed2", "qd2", ("v",), horizon=5, exact=True)]
    got = {r["qid"]: r for r in attach_date_profile(qs, ev, ["k"], specs, totals={"v": "all_v"}).collect()}
    assert len(got) == len(queries)
    for k, q1, q2, qid in queries:
        mine = [e for e in events if k is not None and e[0] == k]
        r = got[qid]
        assert r["all_v"] == sum(e[3] for e in mine)
        if q1 is None:
            assert r["a_v_lt"] == 0 and r["a_v_ge"] == 0
        else:
            assert r["a_v_lt"] == sum(e[3] for e in mine if e[1] is not None and e[1] < q1)
            assert r["a_v_ge"] == sum(e[3] for e in mine if e[1] is not None and e[1] >= q1)
        for off in range(6):
            want = 0 if q2 is None else sum(e[3] for e in mine if e[2] is not None and (e[2] - q2).days == off)
            assert r[f"b_v_eq{off}"] == want
        want_gt = 0 if q2 is None else sum(e[3] for e in mine if e[2] is not None and (e[2] - q2).days > 5)
        assert r["b_v_gt"] == want_gt
