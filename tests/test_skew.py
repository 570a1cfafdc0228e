"""One user, one item and one row hold a third of the log each, or nearly."""

import random

import pytest

from rastro.operators import aggregate as ag
from rastro.operators import clean as cl
from rastro.operators import index as ix
from rastro.operators import split as sp
from rastro.operators import transform as tr
from rastro.schemas import EVENTS, EVENT_WEIGHTS


@pytest.fixture(scope="module")
def raw_rows():
    rng = random.Random(13)
    events = ["view", "addtocart", "transaction", "signup"]
    rows = []
    for _ in range(3000):
        user = 5 if rng.random() < 0.4 else rng.randrange(100, 160)
        item = 7.0 if rng.random() < 0.4 else float(rng.randrange(30))
        item = None if rng.random() < 0.05 else item
        event = rng.choice(events)
        number = float(rng.randrange(5)) if event == "transaction" else None
        rows.append((rng.randrange(400) * 3_600_000, user, event, item, number))
    return rows + [rows[0]] * 1500


@pytest.fixture(scope="module")
def raw(spark, raw_rows):
    return spark.createDataFrame(raw_rows, EVENTS).repartition(6)


@pytest.fixture(scope="module")
def clean_rows(raw_rows):
    return {
        (t, u, e, int(i), x) for t, u, e, i, x in raw_rows if i is not None and e in EVENT_WEIGHTS
    }


def order(row):
    t, _, e, i, x = row
    return (t, i, e, x is not None, x or 0.0)


def test_clean(raw, raw_rows, clean_rows, as_rows):
    assert {tuple(r) for r in cl.clean_events(raw).collect()} == clean_rows
    report = cl.cleaning_report(raw).first()
    assert (report.filas_antes, report.filas_despues) == (len(raw_rows), len(clean_rows))
    quality = cl.quality_report(raw).first()
    assert quality.ts_unicos == len({r[0] for r in raw_rows})


def test_features(raw, clean_rows):
    events = tr.transform_events(cl.clean_events(raw))
    got = {r.visitorid: r for r in ag.user_features(events).collect()}
    for user in {r[1] for r in clean_rows}:
        own = [r for r in clean_rows if r[1] == user]
        assert got[user].total_interacciones == len(own)
        assert got[user].productos_distintos == len({r[3] for r in own})
        assert got[user].peso_total == sum(EVENT_WEIGHTS[r[2]] for r in own)


def test_split_and_index(raw, clean_rows, as_rows):
    clean = cl.clean_events(raw)
    train, test = sp.split_events(clean)
    expected = set()
    for user in {r[1] for r in clean_rows}:
        own = sorted((r for r in clean_rows if r[1] == user), key=order)
        if len(own) >= 2:
            expected.add(own[-1])
    assert {tuple(r) for r in test.collect()} == expected
    assert {tuple(r) for r in train.collect()} == clean_rows - expected
    users = sorted({r[1] for r in clean_rows})
    assert as_rows(ix.index_ids(clean, "visitorid", "u")) == [(u, j) for j, u in enumerate(users)]


@pytest.mark.parametrize("hot_rows", [50, 10**6])
def test_rank(raw, clean_rows, hot_rows):
    ranked = sp.recency_rank(cl.clean_events(raw), hot_rows)
    got = {tuple(r)[:5]: r.rank_reciente for r in ranked.collect()}
    for user in {r[1] for r in clean_rows}:
        own = sorted((r for r in clean_rows if r[1] == user), key=order, reverse=True)
        assert [got[r] for r in own] == list(range(1, len(own) + 1))
