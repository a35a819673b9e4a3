"""Every query of the library against its SQL."""

from collections import defaultdict

import numpy as np
import pytest

from episodia.plans import registry

from .compare import DATA, same


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, name):
    same(registry.queries()[name](spark, DATA), registry.oracle_sql()[name])


def test_every_dimension_is_tokenized(spark):
    vectors = {r.vec_id: np.array(r.embedding, float) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()}
    got = {(r.vec_id, r.dim): r.token for r in registry.queries()["n20_action_tokens"](spark, DATA).collect()}
    tokens = {i: 32000 - np.digitize(np.clip(v, -1, 1), np.linspace(-1, 1, 256)) for i, v in vectors.items()}
    assert got == {(i, k): t for i, own in tokens.items() for k, t in enumerate(own)}


def test_every_frame_has_its_history(spark):
    users = defaultdict(list)
    for r in spark.read.parquet(f"{DATA}/events.parquet").orderBy("user_id", "ts", "event_id").collect():
        users[r.user_id].append(r.value)
    got = {(r.ep, r.t0, r.h): (r.value, r.valid) for r in registry.queries()["j1_every_frame"](spark, DATA).collect()}
    assert got == {(u, t, h): (v[max(t - 2 * h, 0)], t - 2 * h >= 0) for u, v in users.items() for t in range(len(v)) for h in range(5)}
