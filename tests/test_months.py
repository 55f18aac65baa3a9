"""Month masks against plain loops over the series of every as-of date."""

import datetime as dt
import random
from collections import defaultdict

import pytest

from ebbline.functions.dates import AsOf, asof_dates, chains
from ebbline.operators import features as fe

CALENDARS = {
    "monthly": asof_dates(train=(dt.date(2020, 1, 1), dt.date(2020, 9, 1))),
    "month ends": asof_dates(train=(dt.date(2020, 1, 31), dt.date(2020, 8, 31))),
    "mixed days": AsOf(tuple((d, "train") for d in (dt.date(2020, 3, 1), dt.date(2020, 3, 15), dt.date(2020, 5, 1), dt.date(2020, 5, 15), dt.date(2021, 5, 15)))),
    "long": asof_dates(train=(dt.date(2010, 1, 1), dt.date(2020, 12, 1))),
}


@pytest.mark.parametrize("name", CALENDARS)
def test_chains_hold_every_series(name):
    asof = CALENDARS[name]
    found = chains(asof, 5)
    seen = {}
    for days, dates in found:
        assert days == sorted(set(days)) and len(days) <= 62
        for as_of, mask in dates.items():
            assert as_of not in seen
            seen[as_of] = [d for i, d in enumerate(days) if mask >> i & 1]
            first = (mask & -mask).bit_length() - 1
            assert mask >> first == (1 << len(seen[as_of])) - 1
    want = defaultdict(list)
    for day, as_of in asof.series(5):
        want[as_of].append(day)
    assert seen == dict(want)
    # Dates one month apart share their days.
    if name == "long":
        assert len(found) <= 4 and sum(len(d) for d, _ in found) < 180


def world(asof, months, seed):
    rnd = random.Random(seed)
    days = sorted({d for d, _ in asof.series(months)})[-25:]
    holders = {f"c{i}": [f"a{rnd.randrange(9)}" for _ in range(rnd.randint(1, 3))] for i in range(20)}
    return rnd, days, holders


def client_map(spark, asof, holders):
    rows = [(d, a, c, "Home Loan") for d in asof.snapshots for c, accounts in holders.items() for a in accounts]
    return spark.createDataFrame(rows, "as_of_date date, AccountNumber string, ClientNumber string, GeneralAccountTypeDescription string")


@pytest.mark.parametrize("name", ["monthly", "month ends", "mixed days"])
def test_attribute_changed_equals_a_plain_loop(spark, name):
    asof = CALENDARS[name]
    rnd, days, holders = world(asof, 5, 3)
    rows = []
    for c in holders:
        street = "x"
        for day in days:
            for kind in ("home", "post"):
                if rnd.random() < 0.7:
                    if rnd.random() < 0.12:
                        street = rnd.choice(["x", "y", "z", None])
                    rows.append((c, kind, day, street))
                    if rnd.random() < 0.03:
                        rows.append((c, kind, day, "w"))
    history = spark.createDataFrame(rows, "ClientNumber string, AddressTypeDescription string, EndOfDayDate date, StreetAddressName1 string")
    want = defaultdict(list)
    series = defaultdict(set)
    for day, as_of in asof.series(5):
        series[as_of].add(day)
    for as_of, mine in series.items():
        for c, accounts in holders.items():
            changed, known = False, False
            for kind in ("home", "post"):
                # Missing values come first in a day.
                values = [v for _, _, v in sorted((d, v is not None, v or "") for cc, k, d, v in rows if cc == c and k == kind and d in mine)]
                known |= bool(values)
                changed |= any(a and b and a != b for a, b in zip(values, values[1:]))
            if known:
                for a in accounts:
                    want[as_of, a].append(changed)
    got = fe.attribute_changed(asof, history, client_map(spark, asof, holders))
    assert {(r.as_of_date, r.AccountNumber): r.AddressChangedIn6M for r in got.collect()} == {k: int(any(v)) for k, v in want.items()}
    assert any(map(any, want.values())) and not all(map(any, want.values()))


@pytest.mark.parametrize("name", ["monthly", "mixed days"])
def test_activity_change_equals_a_plain_loop(spark, name):
    asof = CALENDARS[name]
    rnd, days, holders = world(asof, 9, 4)
    rows = [(c, d, None if rnd.random() < 0.2 else rnd.randrange(9)) for c in holders for d in days if rnd.random() < 0.6]
    activity = spark.createDataFrame(rows, "ClientNumber string, EndOfDayDate date, web long")
    series = defaultdict(set)
    for day, as_of in asof.series(9):
        series[as_of].add(day)
    want = {}
    for as_of, mine in series.items():
        sums, linked = defaultdict(lambda: defaultdict(list)), set()
        for c, d, v in rows:
            if d in mine:
                back = (as_of.year - d.year) * 12 + as_of.month - d.month
                for a in holders[c]:
                    linked.add(a)
                    if v is not None:
                        sums[a][back].append(v)
        for a in linked:
            mean = [[sum(v) for b, v in sums[a].items() if lo <= b <= hi] for lo, hi in ((0, 2), (3, 8))]
            recent, prior = (sum(m) / len(m) if m else None for m in mean)
            want[as_of, a] = (recent - prior) / prior if recent is not None and prior else None
    got = fe.activity_change(asof, client_map(spark, asof, holders), activity, measures={"web": "change"})
    got = {(r.as_of_date, r.AccountNumber): r.change for r in got.collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) if want[k] is not None else got[k] is None for k in want)
