import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from wordloom.llm.exact_dedup import drop_copies, exact_groups

DIGESTS = {
    "usual": {},
    "one hash collides": {"digest": lambda t: F.lit("same")},
    "both collide": {"digest": lambda t: F.lit("same"), "check": lambda t: F.lit("same")},
    "some collide": {"digest": lambda t: F.length(t), "check": lambda t: F.length(t)},
}


def expected(rows, keep):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    best = {t: keep([i for i in ids if i is not None], default=None) for t, ids in groups.items()}
    return {(r[0], best[r[1] or ""], len(groups[r[1] or ""]), hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in rows}


@pytest.mark.parametrize("case", DIGESTS)
@pytest.mark.parametrize("keep", ["min", "max"])
def test_groups(odd, odd_rows, case, keep):
    got = exact_groups(odd, keep=keep, **DIGESTS[case]).collect()
    assert len(got) == len(odd_rows)
    assert {(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got} == expected(odd_rows, {"min": min, "max": max}[keep])
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r[1] or "" for r in odd_rows})
    assert all(r.doc_id == r.keep_id for r in kept)


@pytest.mark.parametrize("case", ["usual", "one hash collides"])
@pytest.mark.parametrize("keep", ["min", "max"])
def test_survivors(odd, odd_rows, case, keep):
    options = {k: v for k, v in DIGESTS[case].items() if k == "digest"}
    left = drop_copies(odd, keep=keep, **options)
    assert left.columns == odd.columns
    rows = [tuple(r) for r in left.collect()]
    assert len(rows) == len({r[1] or "" for r in odd_rows})
    assert set(rows) <= set(odd_rows)
    same = [r for r in rows if r[1] == "a b c d e f g h"]
    assert [r[0] for r in same] == [1 if keep == "min" else 2]


def test_empty_table(none):
    assert exact_groups(none).collect() == []
    assert drop_copies(none).collect() == []


def test_no_python_in_the_plan(odd):
    plan = exact_groups(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_unknown_choice(odd):
    with pytest.raises(ValueError):
        exact_groups(odd, keep="any")
    with pytest.raises(ValueError):
        drop_copies(odd, keep="any")
