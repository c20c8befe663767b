"""Licences, secrets, token counts, packing and token files against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from farelane.llm.op01_licenses import NOTICES, scan_licenses
from farelane.llm.op02_secrets import redact, scan_secrets
from farelane.llm.op03_token_counts import count_tokens
from farelane.llm.op04_packing import fullest, minimum_slack, pack
from farelane.llm import op10_token_files, tokens
from farelane.llm.op10_token_files import (
    file_bytes,
    open_file,
    read_token_files,
    sequences,
    token_files,
    write_token_files,
)
from farelane.llm.tokens import Pieces
from farelane.session import fresh_path

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def _ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v) for v in r))


def _encoded(odd, tokenizer):
    texts = [(r.doc_id, r.text or "") for r in odd.select("doc_id", "text").collect()]
    library = Tokenizer.from_file(tokenizer)
    return [(i, t, library.encode(t, add_special_tokens=False).ids) for i, t in texts]


def test_licences(odd, none):
    def expected(doc, text):
        words = WORD.findall((text or "").translate(LOWER))
        found = [
            (k, label)
            for phrase, label in PHRASES.items()
            for k in range(len(words))
            if words[k : k + len(phrase.split())] == phrase.split()
        ]
        at = [k for k, _ in found]
        return (doc, len(words), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found})))

    got = scan_licenses(odd)
    rows = [tuple(r)[:6] for r in got.collect()]
    assert _ordered(rows) == _ordered([expected(r.doc_id, r.text) for r in odd.collect()])
    assert scan_licenses(none).count() == 0


def test_licence_notices_are_found_in_place(make):
    rows = [(k, "Some code. " + t.text.title() + ". More words") for k, t in enumerate(NOTICES)]
    damaged = NOTICES[0].text.replace("any person", "every body")
    cut = NOTICES[0].text.replace("free of charge", "at a price")
    got = {r.doc_id: r for r in scan_licenses(make(*rows, (100, damaged), (101, cut))).collect()}
    for k, t in enumerate(NOTICES):
        assert t.label in got[k].labels.split(",") and got[k].score == 1.0
    assert got[100].labels == "mit" and 0.8 <= got[100].score < 1
    assert got[101].labels == "" and got[101].score == 0


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def _spans(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def test_secrets(odd, none, make):
    extra = make((50, "Password: token: abcdefgh ſecret=abcdefgh \U0001f600 API_KEY = 'a.b/c=d' token=12345"))
    docs = odd.unionByName(extra)
    got = scan_secrets(docs)
    names = ("assign", "access", "hex")

    def expected(doc, text):
        spans = _spans(text or "")
        joined = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in spans)
        counts = [sum(k == n for _, k, _ in spans) for n in range(3)]
        return (doc, *counts, hashlib.sha256(joined.encode()).hexdigest(), joined)

    rows = [tuple(r)[:6] for r in got.collect()]
    assert _ordered(rows) == _ordered([expected(r.doc_id, r.text) for r in docs.collect()])
    assert scan_secrets(none).count() == 0


def test_owners_part_examples_from_live_secrets(spark):
    copied, live = "ghp_" + "g1" * 20, "ghp_" + "z2" * 20
    rows = [(k, f"key {copied} end", f"owner{k % 4}") for k in range(40)]
    rows += [(100 + k, f"my {live} end password=letmein99", "owner7") for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in scan_secrets(docs).collect()}
    assert got[0].spans == "" and got[0].n_copied == 1
    assert got[100].spans == "issued:3:47,assign:52:70" and got[100].n_live == 2
    masked = {r.doc_id: r.text for r in redact(docs).collect()}
    assert masked[0] == rows[0][1] and masked[100] == "my [SECRET] end [SECRET]"
    assert redact(docs).count() == 45


def test_redacting_keeps_rows_and_columns(odd, none):
    assert redact(odd).columns == odd.columns and redact(odd).count() == odd.count()
    assert redact(none).count() == 0


def test_token_counts(odd, none, tokenizer):
    got = [tuple(r) for r in count_tokens(odd, tokenizer, 2048).collect()]
    want = [(i, len(t.encode()), len(x), len(x) > 2048) for i, t, x in _encoded(odd, tokenizer)]
    assert _ordered(got) == _ordered(want)
    assert count_tokens(none, tokenizer, 2048).count() == 0


def test_token_counts_of_random_texts(make, tokenizer):
    rng = random.Random(3)
    marks = ["a", "B", "é", "É", ".", ",", "'", "s", "<|", "|>", " ", "\n", " ", "́", "1", "日", "\x1f", "İ", "-", "endoftext"]
    docs = make(*[(k, "".join(rng.choices(marks, k=40))) for k in range(400)])
    got = {r.doc_id: r.n_tokens for r in count_tokens(docs, tokenizer, 9).collect()}
    assert got == {i: len(x) for i, _, x in _encoded(docs, tokenizer)}


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_ids_of_a_slice_take_little_more_than_the_slice(tokenizer):
    """Beside its ids, a slice's words need one number each while the ids are put in place."""
    words = np.array(["apple", "Straße,", "naïve", "x1y2", "end."])[np.random.default_rng(1).integers(0, 5, 400_000)]
    pieces = Pieces(pa.array([" ".join(words)], pa.large_string()), tokenizer)
    tracemalloc.start()
    ids, starts = pieces.ids(1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert starts.tolist() == [0, len(ids)] and ids[-1] == 1
    # Eight bytes a word for its place and as many while they are summed; the rest does not grow.
    assert peak < ids.nbytes + 20 * len(words) + (8 << 20)


def test_ids_across_blocks_of_words(monkeypatch, tokenizer):
    library = Tokenizer.from_file(tokenizer)
    texts = ["", "one, two three.", "", "", "a b c d e f g. h,", "É x", "   ", "last."]
    expected = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for block in (1, 3, 5, 1000):
        monkeypatch.setattr(tokens, "GATHERED_WORDS", block)
        monkeypatch.setattr(tokens, "ENCODED_WORDS", block)
        for end in (None, 1):
            pieces = Pieces(pa.array(texts, pa.large_string()), tokenizer)
            ids, starts = pieces.ids(end)
            got = [ids[a:b].tolist() for a, b in zip(starts, starts[1:])]
            assert got == [x + [end] * (end is not None) for x in expected]
        assert pieces.counts().tolist() == [len(x) for x in expected]


def test_packing(odd, none, tokenizer):
    got = pack(odd, tokenizer, 64).collect()
    want = []
    for doc, _, ids in _encoded(odd, tokenizer):
        ids = [*ids, 1]
        want += [(doc, k // 64, k, len(ids[k : k + 64]), _crc(ids[k : k + 64])) for k in range(0, len(ids), 64)]
    assert _ordered([tuple(r)[:5] for r in got]) == _ordered(want)
    bins: dict = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in bins.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 64
    assert len(bins) <= -(-sum(r.length for r in got) // 64) + 1
    assert pack(none, tokenizer).count() == 0


def test_fullest_combination_is_the_best():
    rng = random.Random(1)
    for _ in range(200):
        items = [rng.randint(1, 30) for _ in range(rng.randint(0, 9))]
        room = rng.randint(1, 60)
        counts = {k: items.count(k) for k in set(items)}
        chosen = fullest(counts, room)
        sums = {0}
        for x in items:
            sums |= {s + x for s in sums}
        assert sum(k * n for k, n in chosen.items()) == max(s for s in sums if s <= room)
        assert all(n <= counts[k] for k, n in chosen.items())


def test_plan_uses_every_item_once():
    histogram = {k: 1 + k * 7 % 5 for k in range(1, 101, 3)}
    used: dict = {}
    for bins, combination in minimum_slack(histogram, 100):
        assert sum(k * n for k, n in combination) <= 100
        for k, n in combination:
            used[k] = used.get(k, 0) + bins * n
    assert used == histogram


def test_token_files_round_trip(odd, none, tokenizer):
    got = [tuple(r) for r in token_files(odd, tokenizer).orderBy("start").collect()]
    encoded = _encoded(odd, tokenizer)
    assert sorted((str(r[0]), r[2], r[3]) for r in got) == sorted((str(i), len(x) + 1, _crc([*x, 1])) for i, _, x in encoded)
    ids = [r[0] for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    end = 0
    for _, start, n, _ in got:
        assert start == end
        end += n
    assert token_files(none, tokenizer).count() == 0


def test_token_files_of_many_ranges_and_a_hot_id(spark, tokenizer):
    texts = [(7, f"copy {i % 40} of {i}") for i in range(120)] + [(7, "the same")] * 30 + [(i, f"text {i}") for i in range(60)]
    docs = spark.createDataFrame([*texts, (None, "no id"), (3, None)], "doc_id long, text string").repartition(3)
    root = fresh_path(spark, "files")
    listed = write_token_files(docs, tokenizer, root, partitions=7)
    assert listed.count() > 3
    got = read_token_files(listed, root).orderBy("start").collect()
    encoded = _encoded(docs, tokenizer)
    assert sorted((str(r[0]), r[2], r[3]) for r in got) == sorted((str(i), len(x) + 1, _crc([*x, 1])) for i, _, x in encoded)
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    assert [r.start for r in got[1:]] == [r.start + r.n_tokens for r in got[:-1]]


def test_parts_of_ids_are_whole_documents(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(op10_token_files, "FILE_IDS", 4)
    values = [np.arange(n, dtype="<u2") for n in (1, 3, 9, 1, 1)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(9)), "ids": pa.array([b""] * 4 + [x.tobytes() for x in values])}).slice(4)
    parts = list(op10_token_files.parts_of(batch))
    assert len(parts) > 1
    assert [i for ids, _, _ in parts for i in ids.to_pylist()] == [4, 5, 6, 7, 8]
    assert [x.tolist() for _, at, ids in parts for x in np.split(ids, at[1:-1])] == [x.tolist() for x in values]


def test_token_file_is_read_without_a_copy():
    import pyarrow as pa

    ids = np.arange(10, dtype=np.uint16)
    documents, batches = open_file(file_bytes(pa.array([4, 5]), np.array([0, 3, 10]), ids, 4))
    assert documents.to_pydict() == {"doc_id": [4, 5], "start": [0, 3], "n_tokens": [3, 7]}
    rows = sequences(batches[0])
    assert rows.tolist() == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9, 0, 0]] and not rows.flags.owndata
    assert batches[0].column("mask").to_pylist()[2] == [True, True, False, False]


def test_other_columns_do_not_matter(odd, tokenizer):
    plain = odd.select("doc_id", "text", "source")
    for run in (scan_licenses, scan_secrets, lambda d: count_tokens(d, tokenizer, 5), lambda d: pack(d, tokenizer)):
        names = [c for c in run(odd).columns if c not in ("found", "sequence_id", "offset")]
        a, b = (sorted(map(str, run(d).select(*names).collect())) for d in (odd, plain))
        assert a == b
