"""What a Python worker holds beside its slice: it shares its executor's memory with the JVM."""

from __future__ import annotations

import os
import tracemalloc
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from farelane.llm import op04_packing, op06_toxicity, op07_jaccard_join
from farelane.llm.texts import slices
from farelane.llm.tokens import load

MB = 1 << 20


class _Taken(Exception):
    pass


@pytest.fixture
def worker(monkeypatch, make):
    """What ``build`` hands to mapInArrow for a table of texts, to be called here."""

    def of(build):
        docs, given = make((1, "a b c")), []

        def take(self, function, schema):
            given.append(function)
            raise _Taken

        with monkeypatch.context() as patch:
            patch.setattr(type(docs), "mapInArrow", take)
            with pytest.raises(_Taken):
                build(docs)
        return given[0]

    for module in (op04_packing, op07_jaccard_join):
        monkeypatch.setattr(module, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    return of


def _held(run, column: str, words: int = 100_000) -> list[int]:
    """Traced bytes that are held when each batch is asked for."""
    held = []

    def batches():
        for i in range(3):
            texts = [" ".join(f"w{(k * 7919 + i) % 5000}" for k in range(words))] * 3
            held.append(tracemalloc.get_traced_memory()[0])
            yield pa.RecordBatch.from_pydict({column: pa.array([3 * i, 3 * i + 1, 3 * i + 2]), "text": pa.array(texts)})

    tracemalloc.start()
    try:
        assert sum(x.num_rows for x in run(batches())) >= 9
    finally:
        tracemalloc.stop()
    return held


def test_packing_keeps_nothing_of_a_slice(worker):
    path = public_tokenizers.path("word_bpe_49k.json")
    load(path).encode("a")
    held = _held(worker(lambda docs: op04_packing.cut_pieces(docs, path, 4096, 1)), "doc_id")
    assert held[1] - held[0] < MB and held[2] - held[1] < MB


def test_scoring_keeps_nothing_of_a_slice(worker):
    weights = {i: 0.5 for i in range(0, 1 << op06_toxicity.BITS, 2)}
    held = _held(worker(lambda docs: op06_toxicity._scored(docs, weights, "text")), "doc")
    assert held[1] - held[0] < MB // 4 and held[2] - held[1] < MB // 4


def test_a_sketch_of_a_task_is_narrow(worker):
    own = worker(lambda docs: op07_jaccard_join.count_sketch(docs, 2))
    texts = pa.array(["a b c", "b c d", None, " ".join(["x"] * 70_000)])
    tracemalloc.start()
    try:
        found = {}
        for batch in own(pa.RecordBatch.from_pydict({"text": x}) for x in (texts, pa.array(["y z"] * 300))):
            kind = batch.column("kind")[0].as_py()
            size = {"shingles": np.uint8, "words": np.uint16}[kind]
            found[kind] = np.concatenate([np.frombuffer(x.as_py(), size) for x in batch.column("cells")])
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 60 * MB
    # "b c" stands in two documents, "y z" in 300, which stop at 255; x and its pair once each.
    assert sorted(found["shingles"][found["shingles"] > 0].tolist()) == [1, 1, 1, 2, 255]
    assert sorted(found["words"][found["words"] > 0].tolist()) == [1, 1, 2, 2, 300, 300, 65535]


def test_workers_give_memory_back_and_encode_in_one_thread(monkeypatch):
    monkeypatch.delenv("TOKENIZERS_PARALLELISM", raising=False)
    load.cache_clear()
    load(public_tokenizers.path("word_bpe_49k.json"))
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["a", None])})
    assert [x.column("text").to_pylist() for x in slices([batch])] == [["a", ""]]
    assert pa.default_memory_pool().backend_name == "system"
