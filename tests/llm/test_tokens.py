"""Token files, encoding, packing and shards against the tokenizers library and plain Python."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from ideamill.llm import bpe, packing, shards, token_files
from ideamill.llm.queries import QUERIES, VOCABULARY
from tests.llm.conftest import edge_rows


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_op1_reads_back_every_row_in_key_order(spark, edge_folder, library):
    got = QUERIES["op1_token_files"](spark, edge_folder).collect()
    ids = [(d, ids_of(library, t) + [2]) for d, t in edge_rows()]
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((d, len(x), crc(x)) for d, x in ids)
    place = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == place
        place += r.n_tokens
    keys = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))


def test_op1_lookup_by_key(spark, edge_docs, library, tmp_path, monkeypatch):
    path = str(tmp_path / "files")
    token_files.write_token_files(edge_docs, path, VOCABULARY, 2, shards=4)
    wanted = spark.createDataFrame([(3,), (20,), (20,), (999,), (None,), (2**40,)], "doc_id long")
    got = Counter((r.doc_id, tuple(r.ids)) for r in token_files.lookup(token_files.token_files(spark, path), wanted).collect())
    assert got == Counter((d, tuple(ids_of(library, t) + [2])) for d, t in edge_rows() if d in (3, 20, 2**40))


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(1).integers(-2**62, 2**62, 5_000))
    index, slots = token_files.PerfectHash.build(keys)
    assert sorted(slots) == list(range(len(keys))) and (index.find(keys) == slots).all()
    assert (index.find(keys + 1) < 0).mean() > 0.999


def test_op3_matches_the_library(spark, edge_folder, library):
    got = QUERIES["op3_rank_array_bpe"](spark, edge_folder).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = Counter()
    for d, t in edge_rows():
        ids = ids_of(library, t)
        want[d, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want


def test_encode_and_decode_tables(spark, edge_docs, library):
    encoded = bpe.encode_texts(edge_docs, VOCABULARY)
    assert Counter((r.doc_id, tuple(r.ids)) for r in encoded.collect()) == Counter((d, tuple(ids_of(library, t))) for d, t in edge_rows())
    decoded = bpe.decode_ids(encoded, VOCABULARY).collect()
    assert Counter(r.text for r in decoded) == Counter(library.decode(ids_of(library, t), skip_special_tokens=False) for _, t in edge_rows())


def test_long_words_merge_alike(library):
    own = bpe.RankArrayBpe.of(VOCABULARY)
    for n in (255, 256, 257, 3_000):
        word = ("thereandback" * n)[:n]
        assert own.encode([word])[0] == ids_of(library, word)


def test_op6_packs_each_id_once(spark, edge_folder, library):
    got = QUERIES["op6_best_fit_packing"](spark, edge_folder).collect()
    want = Counter()
    for d, t in edge_rows():
        ids = ids_of(library, t) + [1]
        for s in range(0, len(ids), 2048):
            want[d, s, len(ids[s:s + 2048]), crc(ids[s:s + 2048]), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    rows = defaultdict(list)
    for r in got:
        rows[r.sequence_id].append((r.offset, r.length))
    assert sorted(rows) == list(range(len(rows)))
    for spans in rows.values():
        place = 0
        for offset, n in sorted(spans):
            assert offset == place
            place += n
        assert place <= 2048


def test_best_fit_is_the_tightest():
    lengths = np.sort(np.random.default_rng(2).integers(1, 101, 3_000))[::-1]
    sequence, offset, used = packing.best_fit_decreasing(lengths, 100)
    rooms = []
    for n, s, o in zip(lengths.tolist(), sequence.tolist(), offset.tolist()):
        fits = [r for r in rooms if r >= n]
        assert 100 - o == (min(fits) if fits and n < 100 else 100)
        if s == len(rooms):
            rooms.append(100)
        assert rooms[s] == 100 - o
        rooms[s] -= n
    assert used == len(rooms) and sum(rooms) < 0.02 * 100 * used


def test_op2_keeps_groups_whole_and_balances(spark, edge_folder):
    got = QUERIES["op2_karmarkar_karp"](spark, edge_folder).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in edge_rows())
    by_text, slots = defaultdict(set), defaultdict(list)
    for r in got:
        by_text[r.text_crc32, r.size].add(r.shard)
        slots[r.shard].append(r.slot)
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and {r.law for r in got} == {"bytes"}


def test_differencing_beats_greedy_spread():
    sizes = np.random.default_rng(4).integers(1, 10_000, 400).tolist()
    final, places = shards.differencing([[s] + [0] * 7 for s in sizes])
    sums = [0] * 8
    for s, p in zip(sizes, places):
        sums[p[0]] += s
    assert sorted(sums) == sorted(final) and max(sums) - min(sums) <= 20
    halves = [shards.differencing([[s] + [0] * 7 for s in sizes[i::2]])[0] for i in (0, 1)]
    joined, _ = shards.differencing(halves)
    assert sum(joined) == sum(sizes) and max(joined) - min(joined) <= 20


def test_op2_levels_hot_groups_among_many(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shards, "GROUPS_PER_PART", 2_048)
    sizes = np.random.default_rng(6).integers(50, 150, 8_000).tolist()
    # One group with a tenth of all bytes, some of a hundredth, and many a hundred times the usual size.
    sizes += [sum(sizes) // 7] + [sum(sizes) // 70] * 9 + [9_000 + i for i in range(20)]
    path = str(tmp_path / "groups")
    spark.createDataFrame([(f"{i:06x}", s) for i, s in enumerate(sizes)], "digest string, size long").write.parquet(path)
    got = {r.digest: r.shard for r in shards.balanced_groups(spark.read.parquet(path), 8).collect()}
    sums = [0] * 8
    for i, s in enumerate(sizes):
        sums[got[f"{i:06x}"]] += s
    assert len(got) == len(sizes) and max(sums) - min(sums) <= 0.001 * sum(sizes) / 8


@pytest.mark.parametrize("name", ["op1_token_files", "op2_karmarkar_karp", "op3_rank_array_bpe", "op6_best_fit_packing"])
def test_empty_table(spark, empty_folder, name):
    assert QUERIES[name](spark, empty_folder).count() == 0


def test_op3_writes_the_texts_of_a_word_once(library):
    """A word and the marks after it are encoded apart; their digest texts are joined, not made again."""
    made = []

    class Counted(bpe.RankArrayBpe):
        def _value(self, ids):
            made.append(ids)
            return super()._value(ids)

    text = "alpha beta. gamma. gamma, beta, <|x alpha."
    own = Counted(VOCABULARY)
    (n, ids, decoded), empty = own.both_as_text([text.replace("<|", "").encode(), b""])
    want = ids_of(library, text.replace("<|", ""))
    assert (n, ids.decode()) == (len(want), " ".join(map(str, want)))
    assert decoded.decode() == library.decode(want, skip_special_tokens=False) and empty == (0, b"", b"")
    # alpha, beta, gamma, x, the full stop and the comma.
    assert len(made) == 6
