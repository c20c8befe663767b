from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from farelane.functions.features import add_features
from farelane.operators import model as m
from farelane.operators.quality import clean
from farelane.sources.derived import trips
from farelane.sources.readers import read_requests
from farelane.streaming.requests import load_valid, rejects, validate
from farelane.streaming import scoring
from farelane.streaming.scoring import read_commits, read_rejects, read_scored, score_stream

GOOD = {
    "pickup_latitude": 41.5,
    "pickup_longitude": -72.25,
    "dropoff_latitude": 42.125,
    "dropoff_longitude": -71.5,
    "pickup_datetime": "2016-07-09 13:20:05+00:00",
}


def _text(**change):
    return json.dumps({k: v for k, v in {**GOOD, **change}.items() if v != "absent"})


CASES = [
    (_text(), []),
    (_text(pickup_latitude="40.75"), []),
    (_text(pickup_latitude=" 1e1 "), []),
    (_text(pickup_latitude=0, pickup_longitude=0), []),
    (_text(pickup_latitude=90, dropoff_longitude=-180.0), []),
    (_text(pickup_datetime="2009-01-01T10:00Z"), []),
    (_text(pickup_latitude="absent"), ["pickup_latitude:required"]),
    (_text(pickup_latitude=None), ["pickup_latitude:null"]),
    (_text(pickup_latitude=True), ["pickup_latitude:invalid"]),
    (_text(pickup_latitude="5f"), ["pickup_latitude:invalid"]),
    (_text(pickup_latitude="NaN"), ["pickup_latitude:invalid"]),
    (_text(pickup_latitude=float("nan")), ["pickup_latitude:invalid"]),
    (_text(pickup_latitude=[1]), ["pickup_latitude:invalid"]),
    (_text(pickup_latitude=""), ["pickup_latitude:invalid"]),
    (_text(pickup_latitude=90.01), ["pickup_latitude:range"]),
    (_text(dropoff_longitude=-181, pickup_datetime=None), ["dropoff_longitude:range", "pickup_datetime:null"]),
    (_text(pickup_datetime="2009-01-01"), ["pickup_datetime:invalid"]),
    (_text(pickup_datetime="12:00"), ["pickup_datetime:invalid"]),
    (_text(pickup_datetime="2009-13-01 10:00:00"), ["pickup_datetime:invalid"]),
    (_text(pickup_datetime=20090101), ["pickup_datetime:invalid"]),
    (_text(tip=1, fare_amount=2), ["fare_amount:unknown", "tip:unknown"]),
    ('{"pickup_latitude": 95, ' + _text()[1:], []),
    ("{}", [f"{f}:required" for f in ("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude", "pickup_datetime")]),
    ("not json", ["request:invalid"]),
    (_text()[:-1], ["request:invalid"]),
    (_text() + " " + _text(), ["request:invalid"]),
    ("null", ["request:invalid"]),
    ("[]", ["request:invalid"]),
    ("", ["request:invalid"]),
    (None, ["request:invalid"]),
]


@pytest.fixture
def cases(spark):
    rows = [(i, value) for i, (value, _) in enumerate(CASES)]
    return validate(spark.createDataFrame(rows, "id int, value string"))


def test_errors(cases):
    got = {r.id: r.errors for r in cases.collect()}
    assert got == {i: errors for i, (_, errors) in enumerate(CASES)}


def test_valid_and_rejected(cases):
    valid = {r.id: r for r in load_valid(cases).collect()}
    assert set(valid) == {i for i, (_, errors) in enumerate(CASES) if not errors}
    assert valid[1].pickup_latitude == 40.75 and valid[2].pickup_latitude == 10.0
    bad = rejects(cases)
    assert bad.columns == ["id", "value", "errors"]
    assert {r.id for r in bad.collect()} == {i for i, (_, errors) in enumerate(CASES) if errors}


@pytest.fixture(scope="module")
def model(spark):
    return m.fit_gbt(add_features(clean(trips(spark, "/root/testdata/sf0.001"))), 3, 3)


def _write(folder, name, values):
    (folder / name).write_text("\n".join(values) + "\n")


def _run(spark, model, source, out):
    arriving = read_requests(spark, str(source))
    stream = score_stream(model, arriving, str(out), str(out / "progress"), availableNow=True)
    stream.awaitTermination()


def test_stream(spark, model, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    lines = [v for v, _ in CASES if v]
    n_valid = sum(not e for v, e in CASES if v)
    _write(source, "a.jsonl", lines)
    _run(spark, model, source, out)
    scored = read_scored(spark, str(out))
    assert scored.count() == scored.filter("fare_amount IS NOT NULL").count() == n_valid
    assert read_rejects(spark, str(out)).count() == len(lines) - n_valid

    # Nothing new: a restart from the checkpoint adds nothing.
    _run(spark, model, source, out)
    assert read_scored(spark, str(out)).count() == n_valid

    _write(source, "b.jsonl", [_text(), "not json"])
    _run(spark, model, source, out)
    assert read_scored(spark, str(out)).count() == n_valid + 1
    assert read_rejects(spark, str(out)).filter("errors[0] = 'request:invalid'").count() >= 2


def test_replayed_batch_overwrites(spark, model, tmp_path):
    """The batch is done again when its commit record is lost, as after a crash."""
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    _write(source, "a.jsonl", [_text(), _text(), "not json"])
    _run(spark, model, source, out)
    for name in ("0", ".0.crc"):
        (out / "progress" / "commits" / name).unlink()
    _run(spark, model, source, out)
    assert read_scored(spark, str(out)).count() == 2
    assert read_rejects(spark, str(out)).count() == 1


def test_a_batch_that_dies_between_its_writes_is_not_seen(spark, model, tmp_path, monkeypatch):
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    assert read_scored(spark, str(out)).count() == read_rejects(spark, str(out)).count() == 0
    _write(source, "a.jsonl", [_text(), "not json"])
    _run(spark, model, source, out)

    _write(source, "b.jsonl", [_text(), _text(), "not json"])
    # The rejects are written second; their write fails.
    with monkeypatch.context() as patch:
        patch.setattr(scoring, "rejects", lambda batch: rejects(batch).select("value", F.raise_error(F.lit("killed")).alias("errors")))
        with pytest.raises(Exception, match="killed"):
            _run(spark, model, source, out)
    assert len(list((out / "scored").glob("batch_id=1/attempt=*/part-*"))) > 0
    assert (read_scored(spark, str(out)).count(), read_rejects(spark, str(out)).count()) == (1, 1)
    assert read_commits(spark, str(out)).count() == 1

    _run(spark, model, source, out)
    assert (read_scored(spark, str(out)).count(), read_rejects(spark, str(out)).count()) == (3, 2)
    commits = {r.batch_id: (r.n_scored, r.n_rejects) for r in read_commits(spark, str(out)).collect()}
    assert commits == {0: (1, 1), 1: (2, 1)}


def test_empty_tables_have_the_columns_of_full_ones(spark, model, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    before = {n: f(spark, str(out)).columns for n, f in (("scored", read_scored), ("rejects", read_rejects))}
    _write(source, "a.jsonl", [_text(), "not json"])
    _run(spark, model, source, out)
    assert before == {"scored": read_scored(spark, str(out)).columns, "rejects": read_rejects(spark, str(out)).columns}


def test_stream_equals_batch(spark, model):
    from farelane.streaming.scoring import score_requests

    request = spark.createDataFrame([(_text(),)], "value string")
    got = score_requests(model, validate(request)).first()
    frame = load_valid(validate(request))
    assert got.fare_amount == m.score(model, add_features(frame)).first().predictions
    assert (got.day_of_week, got.hour) == (5, 13)
