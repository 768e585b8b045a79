"""Edit distances of many pairs against the one-pair kernel."""

import random

import pytest
from pyspark.sql import functions as F

from strandlake.operators import alignment as al
from strandlake.operators import distances as ds


@pytest.mark.parametrize("letters,bits", [("ACGT", 1 << 16), ("AC", 8), ("ACGNŁ", 200)])
def test_distances_equal_the_kernel(monkeypatch, letters, bits):
    monkeypatch.setattr(ds, "FIELDS", bits)
    r = random.Random(bits)
    new = lambda n: "".join(r.choice(letters) for _ in range(n))
    texts = [new(r.choice([0, 1, 30, 31, 64, r.randint(1, 300)])) for _ in range(30)]
    own = [(x, y) for x in texts for y in r.sample(texts, 8)]
    assert ds.distance_many([x for x, _ in own], [y for _, y in own]) == [al.global_distance(x, y) for x, y in own]
    assert ds.distance_many([None, "A", None], ["A", None, None]) == [None] * 3


def test_texts_of_a_key_travel_once(spark, monkeypatch):
    """Before, a read was made and sent anew for each of its references."""
    monkeypatch.setattr(ds, "LIST", 3)
    left = spark.createDataFrame([(1, "k", "ACGTACGT"), (2, "k", None), (3, "other", "A"), (4, None, "A")], "id long, key string, q string")
    right = spark.createDataFrame([("k", f"r{i}", "ACGT"[: i % 5] * 3) for i in range(7)] + [("k", "none", None)], "key string, name string, s string")
    got = ds.distances_to(left, right, ["key"], "q", "s", "d")
    want = left.join(right, "key").select("id", "key", "name", F.levenshtein("q", "s").alias("d"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 16
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "levenshtein" not in plan and "_right" in plan


def test_batches_are_cut_by_bytes():
    """Kernels that took a whole batch held all of its texts as Python's own at once."""
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["A" * 1000] * 100), pa.array(range(100))], ["s", "i"])
    parts = list(ds.pieces(batch, ("s",), 10_000))
    assert all(p.num_rows <= 10 for p in parts) and [i for p in parts for i in p.column("i").to_pylist()] == list(range(100))
    assert [p.num_rows for p in ds.pieces(batch.slice(0, 2), ("s",), 1)] == [1, 1]
