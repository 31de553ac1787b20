from __future__ import annotations

import random

import pytest

from helpers import as_set, places
from obsgrid.schema import CATALOGUE_SCHEMA
from obsgrid.sources.catalogue import read_catalogue, select_places, write_catalogue


def test_csv_with_quoted_commas_and_empty_fields(spark, tmp_path):
    path = tmp_path / "places.csv"
    path.write_text(
        ",".join(CATALOGUE_SCHEMA.fieldNames()) + "\n"
        '7,Sinŭiju,Sinuiju,"Korea, North",KP,PRK,"P\'yŏngbuk, Upper",,40.1,124.4,359341.0\n',
        encoding="utf-8",
    )
    got = read_catalogue(spark, str(path), expected=1).first()
    assert (got["city"], got["country"], got["capital"]) == ("Sinŭiju", "Korea, North", None)
    with pytest.raises(ValueError, match="expected 2"):
        read_catalogue(spark, str(path), expected=2)


def test_csv_round_trip(spark, tmp_path):
    table = places(spark, 5)
    write_catalogue(table, str(tmp_path / "c"))
    assert as_set(read_catalogue(spark, str(tmp_path / "c"))) == as_set(table)


def test_csv_with_a_wrong_header_fails(spark, tmp_path):
    path = tmp_path / "bad.csv"
    names = CATALOGUE_SCHEMA.fieldNames()
    path.write_text(",".join(["id", *names[1:]]) + "\n1,a,a,b,c,d,e,,1.0,2.0,3.0\n")
    with pytest.raises(Exception):
        read_catalogue(spark, str(path)).collect()


def test_selection_equals_a_greedy_walk(spark):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        name = f"town {rng.randrange(60)}"
        code = f"C{rng.randrange(25):02d}"
        population = rng.choice([None, float(rng.randrange(50, 400)) * 1000])
        latitude = rng.choice([None, 95.0, *[float(rng.randrange(-80, 80))] * 8])
        rows.append((i, name, name, code, code, code, "x", None, latitude, 1.0, population))
    target, countries, cap, least = 40, 18, 3, 100_000

    kept = [r for r in rows if r[8] is not None and abs(r[8]) <= 90]
    kept.sort(key=lambda r: (-(r[10] or -1), r[0]))
    first = {}
    for r in kept:
        first.setdefault((r[5], r[2]), r)
    pool = [r for r in kept if first[(r[5], r[2])] is r and r[10] is not None and r[10] >= least]
    leaders = {}
    for r in pool:
        leaders.setdefault(r[5], r)
    chosen = sorted(leaders.values(), key=lambda r: (-r[10], r[0]))[:countries]
    counts = {r[5]: 1 for r in chosen}
    ids = {r[0] for r in chosen}
    for r in pool:
        if len(ids) == target:
            break
        if r[0] not in ids and 0 < counts.get(r[5], 0) < cap:
            ids.add(r[0])
            counts[r[5]] += 1

    df = spark.createDataFrame(rows, CATALOGUE_SCHEMA).repartition(6)
    got = select_places(df, target, countries, cap, least)
    assert {r["location_id"] for r in got.collect()} == ids
