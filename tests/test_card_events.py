"""Card states folded from events against an ordered walk."""

from __future__ import annotations

import random

from siftworks.operators import publication


def walked(events):
    state, item, meant = "absent", None, None
    for at, kind in events:
        if state in ("absent", "pending"):
            if kind == "intent":
                state, meant = "pending", at
            elif kind == "failed":
                state, meant = "absent", None
            elif kind == "created":
                state, item, meant = "to_place", None, None
        elif kind in ("placed", "removed"):
            state = "complete" if kind == "placed" else "off_board"
    return state, meant


def test_states_equal_an_ordered_walk(spark):
    rng = random.Random(3)
    kinds = ["intent", "lost", "failed", "created", "placed", "removed", None, "seen"]
    rows, want = [], {}
    for i in range(300):
        events = [(at, rng.choice(kinds)) for at in rng.sample(range(100), rng.randrange(1, 7))]
        rows += [(f"c{i}" if i else None, at, kind, "clash") for at, kind in events]
        want[f"c{i}" if i else None] = walked(sorted(events))
    rows += [("hot", at, "intent", "x") for at in range(1000)]
    want["hot"] = ("pending", 999)
    rng.shuffle(rows)
    got = publication.card_states(spark.createDataFrame(rows, "stable_id string, at int, kind string, state string").repartition(4)).collect()
    assert {r["stable_id"]: (r["state"], r["pending_since"]) for r in got} == want
    assert {s for s, _ in want.values()} == {"absent", "pending", "to_place", "complete", "off_board"}
    assert publication.card_states(spark.createDataFrame([], "stable_id string, at int, kind string")).collect() == []
