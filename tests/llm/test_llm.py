"""Operators against brute force, exact round trips and held-out accuracy, with the odd cases each must stand."""

import base64
import hashlib
import re
import textwrap
import zlib
from collections import Counter
from math import log10

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corvane.llm import bpe, components, decontam, flac, jaccard, langid, license_scan, mixing, pii, planes, quality, queries, simhash
from corvane.llm.common import bucket, table

DIR = "/root/testdata/sf0.001"
LONG = "lorem ipsum dolor " * 4000 + "x" * 20000
TEXTS = [None, "", "   \n ", "Hello World hello world again", "Hello World hello world again", "one", "naïve ça çava ß 漢字 \x1c x", "a  b \n c", "it's 12,345 tests.\n\nDone! <|endoftext|>", LONG]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, word string, score double, node int"


def rows(spark, texts=TEXTS, extra=((None, "no id"),)):
    listed = [(k, t) for k, t in enumerate(texts)] + list(extra)
    return spark.createDataFrame([(k, t, None, "s", None, "clash", "clash", None, None) for k, t in listed], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, DIR, "documents")


def by_id(frame):
    return {r.doc_id: r for r in frame.collect()}


def words_of(text):
    return (text or "").encode().lower().split()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equals_sql(spark, name):
    from tests.oracle import compare

    compare(spark, DIR, name, queries.queries()[name], queries.SQL[name])


# 1


def check_base(got, texts, held):
    counts = Counter()
    for k, t in texts.items():
        if not held(k):
            counts.update([*words_of(t), b"\n"])
    n, v = sum(counts.values()), len(counts)
    for k, t in texts.items():
        tokens = [*words_of(t), b"\n"]
        want = sum(log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        r = got[k]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(counts[w] > 0 for w in tokens), n)
        assert abs(r.base_score - want) < 1e-6 * max(1, abs(want)) and r.score < 0


def test_mixing(spark):
    far = "/root/testdata/sf0.01"
    got = by_id(queries.op1_context_mixing(spark, far))
    texts = {r.doc_id: r.text for r in table(spark, far, "documents").collect()}
    held = lambda k: zlib.crc32(str(k).encode()) % 5 == 1
    check_base(got, texts, held)
    some = [got[k] for k in texts if held(k)]
    assert sum(r.score for r in some) > sum(r.base_score for r in some) and all(r.held_out for r in some)


def test_mixing_head_only_places_words(spark, docs):
    small = docs.limit(40)
    trains = bucket("doc_id", 5) != 1
    a, b = (by_id(mixing.score(small, trains, head=h)) for h in (4, 100_000))
    assert all(a[k].n_known == b[k].n_known and abs(a[k].base_score - b[k].base_score) < 1e-6 for k in a)


def test_mixing_head_leaves_scores(spark, docs):
    small = docs.limit(40)
    a, b = (by_id(mixing.score(small, bucket("doc_id", 5) != 1, head=h)) for h in (4, 100_000))
    assert all(abs(a[k].score - b[k].score) < 1e-4 * max(1, abs(b[k].score)) for k in a)


def test_mixing_odd_rows(spark):
    odd = rows(spark)
    check_base(by_id(mixing.score(odd, F.col("doc_id") >= 0)), dict(enumerate(TEXTS)), lambda k: False)
    check_base(by_id(mixing.score(odd, F.lit(False))), dict(enumerate(TEXTS)), lambda k: True)
    assert mixing.score(odd.where("false"), F.lit(True)).count() == 0


def test_mixing_base_learns_no_mixer(spark, docs, monkeypatch):
    """The counted columns are those of the whole operator, and are had without its mixers."""
    cases = [(rows(spark), F.col("doc_id") >= 0), (rows(spark), F.lit(False)), (docs.limit(40), bucket("doc_id", 5) != 1)]
    whole = [by_id(mixing.score(d, t)) for d, t in cases]
    monkeypatch.setattr(mixing, "fitted", None)
    monkeypatch.setattr(mixing, "count_contexts", None)
    for (d, t), want in zip(cases, whole, strict=True):
        for head in (4, 100_000):
            got = by_id(mixing.base_scores(d, t, head))
            assert got.keys() == want.keys() and all((r.n_tokens, r.n_known, r.train_tokens) == (want[k].n_tokens, want[k].n_known, want[k].train_tokens) and abs(r.base_score - want[k].base_score) < 1e-6 for k, r in got.items())
    assert queries.mixing_base(spark, "/root/testdata/sf0.001").count() == 200 and mixing.base_scores(rows(spark).where("false"), F.lit(True)).count() == 0


def test_mixing_does_not_depend_on_the_layout(spark, docs):
    small = docs.limit(60)
    trains = bucket("doc_id", 5) != 1
    before = spark.conf.get("spark.sql.shuffle.partitions")
    got = []
    for parts in (1, 7):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        got.append(by_id(mixing.score(small.repartition(parts), trains)))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert all(abs(got[0][k].score - got[1][k].score) < 1e-7 * abs(got[0][k].score) for k in got[0]) and len(got[0]) == 60


def test_mixing_reads_across_words(spark):
    rng = np.random.default_rng(3)
    words = [f"w{k}" for k in range(300)]
    texts = [" ".join(rng.choice(words, 400)) for _ in range(30)]
    shuffled = " ".join(rng.permutation(texts[3].split()))
    got = by_id(mixing.score(rows(spark, [*texts, texts[3], shuffled], ()), F.col("doc_id") < 30))
    # a copy of a learned text, and the same words in another order
    assert got[30].score > 0.8 * got[31].score and got[30].bits_per_byte < got[31].bits_per_byte
    assert abs(got[30].base_score - got[31].base_score) < 1e-6


def test_mixing_learns_from_long_texts_too(spark):
    # a word all but tells the next one, which the mixer has to learn; the second corpus is the first one twice, in one text
    rng, w, words = np.random.default_rng(4), 0, []
    for k in range(90_000):
        w = (w * 7 + 1) % 2003 if rng.random() < 0.95 else int(rng.integers(2003))
        words.append(f"word{w}")
    half = " ".join(words)
    assert len(half) < 1 << 20 < 2 * len(half)
    a, b = (by_id(mixing.score(rows(spark, [t], ()), F.lit(True)))[0] for t in (half, f"{half} {half}"))
    assert b.bits_per_byte < 1.02 * a.bits_per_byte


def test_mixers_learn_from_every_token_whatever_the_layout(spark, docs):
    texts = docs.select("doc_id", "text").limit(60)
    common = pa.array(["the", "of"], pa.large_string())
    tokens = mixing.tokens_of(pa.array([r.text for r in texts.collect()], pa.string()), common)
    table, _ = mixing.count_contexts(texts, common)
    table[: 2 * mixing.ACROSS[0]] = mixing.prefix_table(np.bincount((tokens.hashes[tokens.ids] >> np.uint64(64 - mixing.BITS)).astype(int), minlength=1 << mixing.BITS))
    columns = lambda batch: mixing.coded(mixing.tokens_of(batch.column(1), common))
    a, b = (mixing.fitted(texts.repartition(parts), "doc_id", 3, table, mixing.across_learner, columns) for parts in (1, 5))
    assert a.mass.sum() == mixing.BITS * len(tokens.ids) == (a.refined - mixing.across_learner(table).mixer.refined).sum().round()
    assert (a.weights == b.weights).all() and (a.refined == b.refined).all()


def learned_plainly(counts, gates, x, bits, gate_of, width):
    """Weights after online steps over rows: counts (row, predictor, zeros and ones) with the row's own bit in them."""
    weights = np.full((gates, counts.shape[1]), 1.8 / counts.shape[1])
    for a in range(0, len(x), width):
        n = counts[a : a + width].astype(float)
        one = bits[a : a + width]
        n[np.arange(len(n)), :, one] -= 1
        s, gate = np.log((n[..., 1] + 0.25) / (n[..., 0] + 0.25)), gate_of(n.sum(2))
        error = one - 1 / (1 + np.exp(-np.clip((weights[gate] * s).sum(1), -8, 8)))
        mass = np.bincount(gate, minlength=gates)[:, None] + 20
        step, spread = np.zeros((2, *weights.shape))
        np.add.at(step, gate, error[:, None] * s)
        np.add.at(spread, gate, s * s)
        weights += 0.15 * step / mass / np.sqrt(1 + spread / mass)
    return weights


def test_mixers_learn_by_lookup_what_counts_say(monkeypatch):
    rng, logs, plain = np.random.default_rng(7), [], mixing.log_odds
    monkeypatch.setattr(mixing, "log_odds", lambda a, b: logs.append(np.size(a)) or plain(a, b))
    tokens = mixing.tokens_of(pa.array([" ".join(f"w{k}" for k in rng.geometric(0.02, 500)) for _ in range(10)]), pa.array(["w1", "w2"], pa.large_string()))
    table, h = np.zeros(2 * mixing.ACROSS_STARTS[-1], np.float32), tokens.hashes[tokens.ids]
    mixing.count_across(tokens, table)
    table[: 2 * mixing.ACROSS[0]] = mixing.prefix_table(np.bincount((h >> np.uint64(64 - mixing.BITS)).astype(int), minlength=1 << mixing.BITS))
    cost = []
    for times in (1, 3):  # a step takes no logarithm: their number follows the table, not the tokens
        logs.clear()
        learner = mixing.across_learner(table)
        for _ in range(times):
            learner.add(mixing.coded(tokens))
        mixer = learner.close()
        cost.append(sum(logs))
        assert mixer.mass.sum() == times * mixing.BITS * len(h)
    assert cost[0] == cost[1] <= len(table)
    # the first bit of each token, straight from the counts
    bits, term, before = (h >> np.uint64(63)).astype(int), mixing._term(np.ones(len(h), np.uint64)), mixing.scattered(tokens.before)
    places = [np.ones(len(h), int), *(mixing.across_slots(k, term, before) + mixing.ACROSS_STARTS[k] for k in (1, 2, 3))]
    counts = table.reshape(-1, 2)[np.stack(places, 1)]
    level = lambda n: np.minimum((np.log2(n + 1) + 2) / 3, 3).astype(int)
    want = learned_plainly(counts, 16, h, bits, lambda n: level(n[:, 1]) * 4 + level(n[:, 2]), mixing.STEP_TOKENS)
    assert np.abs(mixing.fit_across(table, tokens).weights[:16] - want).max() < 1e-4


def test_head_words_are_compared_whole(monkeypatch):
    words = pa.array(["b", "a", "c"], pa.large_string())
    asked = pa.array(["c", "x", "a", "a"], pa.large_string())
    head = mixing.Head.of(words, np.array([5, 6, 7]))
    found = lambda head, hashes: [head.counts[k] if k >= 0 else 0 for k in head.places(asked, hashes)]
    assert found(head, mixing.hashed(asked.to_pylist())) == [7, 0, 6, 6]
    # a word that only shares the hash of one, then two of the head that share theirs
    assert found(head, mixing.hashed(["c", "b", "a", "a"])) == [7, 0, 6, 6]
    monkeypatch.setattr(mixing, "hashed", lambda ws: np.zeros(len(ws), np.uint64))
    assert found(mixing.Head.of(words, np.array([5, 6, 7])), np.zeros(4, np.uint64)) == [7, 0, 6, 6]
    none = mixing.Head.of(words[:0], np.zeros(0, np.int64))
    assert none.places(asked, np.zeros(4, np.uint64)).tolist() == [-1] * 4


def test_spelling_is_a_distribution():
    tables, rng = np.zeros(2 * mixing.STARTS[-1], np.float32), np.random.default_rng(0)
    words = [bytes(rng.integers(97, 103, rng.integers(1, 5)).astype(np.uint8)) for _ in range(300)]
    mixing.count_tables(words, np.zeros(300, int), tables)
    model = mixing.Model(tables, mixing.Mixer.fresh())
    # the first byte of all words: 256 one-byte continuations sum to one
    flat = mixing.Flat(np.arange(256, dtype=np.uint8), np.arange(256), np.zeros(256, int), [c[:1].repeat(256) for c in mixing.flatten([b"a"], np.zeros(1, int)).contexts])
    out = np.zeros(256)
    for bit in range(8):
        s, gate = mixing.odds(tables, flat, bit, slice(None))
        p = mixing.refine(model.mixer, bit, mixing.mixed(model.mixer, s, gate))
        out += np.log(np.where(flat.data >> (7 - bit) & 1, p, 1 - p))
    assert abs(np.exp(out).sum() - 1) < 1e-6


def test_hash_bits_are_a_distribution_and_shares_too():
    text = pa.array(["a b c a b d a b", "b c a"])
    tokens, table = mixing.tokens_of(text, pa.array(["b", "a"], pa.large_string())), np.zeros(2 * mixing.ACROSS_STARTS[-1], np.float32)
    assert len(tokens.ids) == 13 and tokens.owner.tolist() == [0] * 9 + [1] * 4 and tokens.before[0][[0, 9]].tolist() == [0, 0]
    mixing.count_across(tokens, table)
    counts = np.bincount((tokens.hashes[tokens.ids] >> np.uint64(64 - mixing.BITS)).astype(int), minlength=1 << mixing.BITS)
    table[: 2 * mixing.ACROSS[0]] = mixing.prefix_table(counts)
    bits = [format(int(h) >> 64 - mixing.BITS, f"0{mixing.BITS}b") for h in tokens.hashes[tokens.ids]]
    for prefix in ("", "0", "1", "10", bits[0][:7]):
        node = int("1" + prefix, 2)
        assert table[2 * node : 2 * node + 2].tolist() == [sum(b.startswith(prefix + x) for b in bits) for x in "01"]
    across = mixing.Across.of(table, mixing.fit_across(table, tokens))
    every = np.arange(1 << mixing.BITS, dtype=np.uint64) << np.uint64(64 - mixing.BITS)
    for at in (0, 1, 2, 12):
        before = tuple(b[at].repeat(len(every)) for b in tokens.before)
        out = across.bits(mixing.Tokens(tokens.distinct, np.arange(len(every)), np.zeros(len(every), int), every, before, tokens.group))
        assert abs(np.exp(out).sum() - 1) < 1e-6
    h = mixing.hashed(["x", "y"])
    mass = np.zeros(1 << mixing.BITS)
    np.add.at(mass, (h >> np.uint64(64 - mixing.BITS)).astype(int), np.array([3.0, 5.0]) - 0.5)
    counts = mixing.Counts(8, 0.125, 0.5, np.maximum(mass, 1e-300))
    assert np.allclose(np.exp(counts.share(np.array([3.0, 5.0]), h)), 0.875)


# 2


def test_language(spark, docs):
    got = by_id(queries.op2_language_id(spark, DIR))
    truth = {r.doc_id: r.lang for r in docs.collect()}
    held = [k for k in truth if got[k].held_out]
    assert np.mean([got[k].lang_pred == truth[k] for k in held]) > 0.9
    model = langid.learn(docs)
    odd = by_id(langid.identify(rows(spark, [*TEXTS, "12 34 !!"]), model))
    assert [odd[k].lang_pred for k in (0, 1, 2, 10)] == ["und"] * 4 and 0 <= odd[3].score <= 1 and odd[3].lang_pred in model.langs
    assert langid.keep_identified(rows(spark, [*TEXTS, "12 34 !!"]), model).columns == rows(spark).columns
    assert {r.doc_id for r in langid.keep_identified(rows(spark, [*TEXTS, "12 34 !!"]), model).collect()} == {3, 4, 5, 6, 7, 8, 9, None}
    nothing = langid.learn(docs.where("false"))
    assert {r.lang_pred for r in langid.identify(docs.limit(3), nothing).collect()} == {"und"}
    assert langid.identify(docs.where("false"), model).count() == 0


def test_language_of_scripts_without_a_name(spark):
    khmer, sinhala, english = "ខ្ញុំ ស្រឡាញ់ ភាសា ខ្មែរ", "මම සිංහල භාෂාව කතා කරමි", "the language of the people"
    learned = spark.createDataFrame([(khmer, "km"), (sinhala, "si"), (english, "en")], "text string, lang string")
    model = langid.learn(learned)
    texts = [khmer, sinhala, english, "१२३ ៤៥ 12 !?", None, "ខ្មែរ"]
    got = by_id(langid.identify(rows(spark, texts, ()), model))
    assert [got[k].lang_pred for k in range(6)] == ["km", "si", "en", "und", "und", "km"] and got[0].score == 1 and got[3].score == 0
    assert {r.doc_id for r in langid.keep_identified(rows(spark, texts, ()), model).collect()} == {0, 1, 2, 5}


def test_viterbi_equals_brute_force():
    rng = np.random.default_rng(3)
    counts = np.array([4, 0, 1, 6])
    scores = rng.normal(0, 3, (11, 3)).astype(np.float32)
    label, at = langid.viterbi(scores, counts, 2.0), 0
    for n in counts:
        total = lambda path: sum(scores[at + t, s] for t, s in enumerate(path)) - 2.0 * sum(a != b for a, b in zip(path, path[1:], strict=False))
        if n:
            best = max(total(p) for p in np.ndindex(*[3] * n))
            assert abs(total(label[at : at + n].tolist()) - best) < 1e-4
        at += n


def test_language_equals_brute_force(spark, docs):
    """Every text decoded by itself, word by word."""
    model = langid.learn(docs)
    texts = [*(r.text for r in docs.orderBy("doc_id").limit(25).collect()), *TEXTS[:-1]]
    texts += [f"{texts[0]} {texts[1]} {texts[2]}", "der the la que die and"]
    got = by_id(langid.identify(rows(spark, texts, ()), model))
    for k, t in enumerate(texts):
        words = langid.split(pa.array([t], pa.string()))
        scores, letters = model.scores(words.distinct)
        state, back = None, []
        for w in words.ids:
            if state is None:
                state = scores[w].astype(float)
                continue
            moved = state[:, None] - langid.SWITCH * (1 - np.eye(len(state)))
            back.append(moved.argmax(0))
            state = moved.max(0) + scores[w]
        path = [] if state is None else [int(state.argmax())]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        weight = np.zeros(len(model.langs))
        for w, label in zip(words.ids, reversed(path), strict=True):
            weight[label] += letters[w]
        want = model.langs[int(weight.argmax())] if weight.sum() else "und"
        assert got[k].lang_pred == want and got[k].score == pytest.approx(weight.max() / max(weight.sum(), 1), abs=2e-2)


def test_viterbi_keeps_many_labels():
    scores = np.full((6, 300), -5, np.float32)
    scores[:3, 150], scores[3:, 299] = 9, 9
    assert langid.viterbi(scores, np.array([6]), 1.0).tolist() == [150] * 3 + [299] * 3


# 3 and 6


def tiktoken_encoding():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(queries.vocabulary("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=queries.pattern(), mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe(spark, docs):
    encoding = tiktoken_encoding()
    sets = [({r.doc_id: r.text for r in docs.collect()}, queries.op3_byte_bpe(spark, DIR)), (dict(enumerate(TEXTS)), bpe.digests(rows(spark), queries.vocabulary("byte_bpe_50k.tiktoken"), queries.pattern()))]
    for texts, frame in sets:
        got = by_id(frame)
        assert set(got) == set(texts)
        for k, t in texts.items():
            ids = encoding.encode_ordinary(t or "")
            assert (got[k].n_tokens, got[k].ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
            assert got[k].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    full = by_id(bpe.encode_decode(rows(spark), queries.vocabulary("byte_bpe_50k.tiktoken"), queries.pattern()))
    assert full[6].decoded == TEXTS[6].encode() and full[0].ids_text == ""


def test_units_keep_pre_tokens():
    import regex

    words, rng = regex.compile(queries.pattern()).findall, np.random.default_rng(1)
    from corvane.llm.memo import Units, pre_tokens

    units = Units(lambda us: [pre_tokens(u, words) for u in us], limit=50)
    for _ in range(3000):
        text = "".join(rng.choice(list("ab'sß1.,  \n\t\x1c x"), rng.integers(0, 25)))
        assert [w for u in units.of(text) for w in u] == words(text), repr(text)


def check_planes(texts, got, tokenizer, ordered):
    start = 0
    for k in ordered:
        ids = [*tokenizer.encode(texts[k] or "", add_special_tokens=False).ids, 0]
        assert (got[k].start, got[k].n_tokens, got[k].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), k
        start += len(ids)


def test_planes(spark, docs):
    from tokenizers import Tokenizer

    path = queries.vocabulary("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    texts = {r.doc_id: r.text for r in docs.collect()}
    check_planes(texts, by_id(queries.op6_token_planes(spark, DIR)), tokenizer, sorted(texts))
    odd = planes.read_planes(planes.write_planes(rows(spark), path, queries.pattern(), bits=True, block_ids=50))
    check_planes(dict(enumerate(TEXTS)), by_id(odd), tokenizer, range(len(TEXTS)))
    assert planes.read_planes(planes.write_planes(docs.where("false"), path, queries.pattern())).count() == 0


@pytest.mark.parametrize("block_ids", [1, 7, 64])
def test_planes_of_documents_over_many_blocks(spark, block_ids):
    from tokenizers import Tokenizer

    path = queries.vocabulary("byte_bpe_50k.json")
    texts = [None, "a b c d e f g h", "", "x <|endoftext|> y<|endoftext|>z", "the end " * 60, "one"] * 3
    blocks = planes.write_planes(rows(spark, texts).coalesce(2), path, queries.pattern(), block_ids=block_ids)
    check_planes(dict(enumerate(texts)), by_id(planes.read_planes(blocks)), Tokenizer.from_file(path), range(len(texts)))
    sizes = blocks.orderBy("shard", "block").collect()
    last = {r.shard: r.block for r in sizes}
    assert all(r.n_ids == block_ids for r in sizes if r.block < last[r.shard])


def test_pieces_of_a_batch_are_encoded_once():
    from tokenizers import Tokenizer

    path, rng = queries.vocabulary("byte_bpe_50k.json"), np.random.default_rng(5)
    bpe, tokenizer = planes.LibraryBPE(path, queries.pattern()), Tokenizer.from_file(path)

    class Model:
        def __init__(self, model):
            self.model, self.asked = model, []

        def tokenize(self, text):
            self.asked.append(text)
            return self.model.tokenize(text)

    bpe.model = Model(bpe.model)
    ids = lambda texts: [np.frombuffer(x, "<u4").tolist() for x in bpe.encode(pa.array(texts))]
    want = lambda texts: [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    some = ["x oddword, oddword; oddword (oddword) oddword. oddword", "y newish; newish! newish, \u00fcbrig; \u00fcbrig"]
    assert ids(some) == want(some)
    assert all(bpe.model.asked.count(x) == 1 for x in ("\u0120oddword", "\u0120newish", "oddword")) and len(set(bpe.model.asked)) == len(bpe.model.asked)
    for _ in range(30):
        texts = ["".join(rng.choice(list("ab'sZ\u00df\u4e2d\u01311.,  \n\t\x1c\u00a0\u3000 x<|>"), rng.integers(0, 40))) for _ in range(50)]
        assert ids(texts) == want(texts)


def test_joined_checksums():
    rng = np.random.default_rng(0)
    for n in (0, 1, 5, 1000):
        a, b = rng.bytes(17), rng.bytes(n)
        assert planes.crc_joined(zlib.crc32(a), zlib.crc32(b), n) == zlib.crc32(a + b)


def test_units_of_batches_equal_single_texts():
    import regex

    from corvane.llm.memo import Units, checked, pre_tokens

    words, rng = regex.compile(queries.pattern()).findall, np.random.default_rng(2)
    units = Units(lambda us: ["|".join(pre_tokens(u, words)).encode() for u in us], limit=20)
    for _ in range(40):
        texts = ["".join(rng.choice(list("ab'sß1.,  \n\t\x1c x"), rng.integers(0, 25))) for _ in range(60)]
        got = units.joined(pa.array(texts), (b"|",))[0].to_pylist()
        assert [x.decode() for x in got] == ["|".join(words(t)) for t in texts]
    with pytest.raises(ValueError):
        checked(r"\S+|\s+")


@pytest.mark.parametrize("bits", [False, True])
def test_plane_blocks(bits):
    ids = np.random.default_rng(0).integers(0, 1 << 32, 1001, dtype=np.uint64).astype("<u4")
    data = planes.pack([1, 0, 1000], ids, bits)
    lengths, back = planes.unpack(data)
    assert lengths.tolist() == [1, 0, 1000] and (back == ids).all()
    assert planes.unpack(planes.pack([], ids[:0], bits))[1].size == 0
    with pytest.raises(ValueError):
        planes.unpack(data[:-9] + bytes([data[-9] ^ 1]) + data[-8:])


# 4


def test_licences(spark, docs):
    text = "Intro.\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\nReleased   under the MIT license.\nThis program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."
    got = by_id(license_scan.scan(rows(spark, [text, None, "", LONG, "Released under the MIT Licence."])))
    assert got[0].licenses == "GPL-2.0-or-later,MIT" and got[0].matches.count("MIT") == 2
    assert [got[k].licenses for k in (1, 2, 3, 4)] == [""] * 4
    found = by_id(queries.op4_license_scan(spark, DIR))
    marks = {"This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only", "Released under the MIT License.": "MIT", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Licensed under the Apache License, Version 2.0.": "Apache-2.0"}
    for r in docs.collect():
        assert {m for s, m in marks.items() if s in r.text} == set(found[r.doc_id].licenses.split(",")) - {"", "Proprietary"}
    assert license_scan.scan(docs.where("false")).count() == 0


@pytest.mark.parametrize("lead", ["", " * ", "# ", "// ", "dnl "])
def test_wrapped_licences(lead):
    by = license_scan.Scanner()
    say = license_scan.SENTENCES

    def found(*paragraphs):
        lines = [line for p in paragraphs for line in [*textwrap.wrap(p, 72), ""]]
        text = "\n".join((lead + line).rstrip() for line in ["Copyright 2020 Some Body", "", *lines])
        return {m[2] for m in by.match(by.identify(text))}

    bsd = (say["bsd-grant"], "1. " + say["bsd-source"], "2. " + say["bsd-binary"])
    assert found(say["mit-grant"], say["mit-keep"], say["mit-as-is"]) == {"MIT"}
    assert found(*bsd) == {"BSD-2-Clause"} and found(*bsd, "3. " + say["bsd-name"]) == {"BSD-3-Clause"}
    assert found(f"{say['gpl-free']} {say['gpl-2-later']}") == {"GPL-2.0-or-later"}
    assert found(say["gpl-3-whole"]) == {"GPL-3.0-or-later"}
    assert found(say["mpl-2"] + " If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.") == {"MPL-2.0"}
    assert found("Some words that end nowhere") == set()
    assert {m[2] for m in by.match(by.identify(f"a line\n{lead}{say['mit-notice']}\nanother"))} == {"MIT"}


def test_more_licences():
    by, say = license_scan.Scanner(), license_scan.SENTENCES

    def found(text):
        return [m[2] for m in by.match(by.identify(text), text)]

    assert {licence for licence, _ in license_scan.RULES} == {x for licence, needed in license_scan.RULES for x in found("\n\n".join(say[s] for s in needed)) if x == licence}
    wrap = lambda *names: "\n\n".join(textwrap.fill(say[n], 70) for n in names)
    assert found(wrap("library-free", "lgpl-2-1-later").replace(";\n\n", "; ")) == ["LGPL-2.1-or-later"]
    assert found(wrap("isc-grant")) == ["ISC"] and found(wrap("zlib-as-is", "zlib-liable", "zlib-grant")) == ["Zlib"]
    assert found("    Apache License\n    Version 2.0, January 2004\n    http://www.apache.org/licenses/\n\n    TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION\n") == ["Apache-2.0"]
    assert found("// SPDX-License-Identifier: MIT\nint x;") == ["MIT"]
    assert found("Copyright (c) 2020, Some Body. All rights reserved.\n\n" + wrap("bsd-grant", "bsd-source", "bsd-binary", "bsd-name")) == ["BSD-3-Clause"]
    assert found("Copyright 2020 Some Body. All rights reserved.") == [] and found("Some text.\nAll rights reserved.\nMore.") == ["Proprietary"]


def test_rules_equal_a_plain_search():
    """Rules tried at every place in order, chains found by trying what comes next."""
    rules = (("X", ("a", "b", "c")), ("X", ("a", "b")), ("Y", ("b", "c")), ("Z", ("a",)))
    by, rng = license_scan.Scanner({n: f"sentence {n}." for n in "abc"}, rules, gap=2, reserved=None), np.random.default_rng(0)
    for _ in range(500):
        names = rng.choice(list("abcoo"), rng.integers(0, 14)).tolist()
        text = "\n".join(f"sentence {n}." if n != "o" else "something else." for n in names)
        used, want = set(), []
        for licence, needed in sorted(rules, key=lambda r: (-len(r[1]), r[0])):
            for start in range(len(names)):
                chain = [start] if names[start] == needed[0] and start not in used else []
                for n in needed[1:] if chain else ():
                    after = [j for j in range(chain[-1] + 1, min(len(names), chain[-1] + 4)) if names[j] == n and j not in used]
                    if not after:
                        chain = []
                        break
                    chain.append(after[0])
                if chain:
                    used.update(chain)
                    want.append((chain[0], chain[-1], licence))
        assert by.match(by.identify(text), text) == sorted(want), names


def test_licences_in_linear_time():
    import time

    by, took = license_scan.Scanner(), []
    for n in (25_000, 100_000):
        text = (license_scan.SENTENCES["mit-notice"] + " " + license_scan.SENTENCES["bsd-grant"] + "\n") * (n // 2)
        known = by.identify(text)
        began = time.perf_counter()
        assert len(by.match(known, text)) == n // 2
        took.append(time.perf_counter() - began)
    assert took[1] < 5 and took[1] < 16 * took[0] + 0.5


# 5


def test_decontamination(spark, docs):
    items = {r.item_id: r.text for r in table(spark, DIR, "benchmark").collect()}
    found = {(r.doc_id, r.item_id) for r in queries.op5_decontamination(spark, DIR).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {(d, i) for d, t in texts.items() for i, x in items.items() if x in t} <= found
    words = {i: decontam.words_of(x) for i, x in items.items()}
    for d, i in found:  # most of the item's trigrams are there
        have = decontam.trigrams(decontam.words_of(texts[d]))
        assert len(decontam.trigrams(words[i]) & have) >= 0.4 * len(decontam.trigrams(words[i]))
    kept = decontam.clean(docs, table(spark, DIR, "benchmark"))
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(texts) - {d for d, _ in found}


def test_decontamination_odd_rows(spark):
    item = "Which river runs past the old mill at dawn? The quiet Ebro runs past it every single morning."
    bench = spark.createDataFrame([(1, item), (1, item), (2, "too short"), (3, None), (None, item)], "item_id long, text string")
    texts = [None, "", item, LONG + " " + item, "Which river runs past the old mill at dawn? Nobody can say.", LONG]
    assert {(r.doc_id, r.item_id) for r in decontam.matches(rows(spark, texts), bench).collect()} == {(2, 1), (3, 1)}
    assert decontam.matches(rows(spark, texts), bench.where("false")).count() == 0
    assert {(r.doc_id, r.item_id) for r in decontam.matches(rows(spark, texts), bench, shard=1).collect()} == {(2, 1), (3, 1)}
    assert decontam.clean(rows(spark, texts), bench).count() == 5


def brute_matches(docs, items):
    """Every window of every text against every item."""
    items = [(i, *decontam.parts(t)) for i, t in items if t and decontam.words_of(t)]
    df = Counter(w for _, q, a in items for w in set(q + a))
    mean, longest = sum(len(q + a) for _, q, a in items) / len(items), max(32, max(len(q + a) for _, q, a in items))
    out = {}
    for d, t in docs:
        words = decontam.words_of(t or "")
        for at in range(0, max(1, len(words)), longest):
            window = words[at : at + 2 * longest]
            for i, q, a in items:
                tf = Counter(q + a)
                gain = {w: np.log1p((len(items) - df[w] + 0.5) / (df[w] + 0.5)) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(q + a) / mean)) for w, n in tf.items()}
                score = sum(g for w, g in gain.items() if w in window) / sum(gain.values())
                found = decontam.verified(window, q, a, 0.5) if score >= 0.5 - 1e-9 else None
                if found:
                    out[d, i] = max(out.get((d, i), 0), score)
    return out


@pytest.mark.parametrize("shard", [20_000, 3])
def test_matches_equal_brute_force(spark, docs, shard):
    rng = np.random.default_rng(8)
    texts = [r.text for r in docs.orderBy("doc_id").limit(30).collect()]
    items = [(r.item_id, r.text) for r in table(spark, DIR, "benchmark").limit(10).collect()]
    for _, t in items[:6]:
        w = t.split()
        for k in rng.integers(0, len(w), 4):
            w[k] = "changed"
        texts += [f"{texts[3]} {t} {texts[4]}", f"{texts[5]} {' '.join(w)} {texts[6]}", " ".join(w[: len(w) // 2])]
    got = {(r.doc_id, r.item_id): r.score for r in decontam.matches(rows(spark, texts, ()), spark.createDataFrame(items, "item_id long, text string"), shard=shard).collect()}
    assert got == pytest.approx(brute_matches(enumerate(texts), items)) and len(got) >= 12


def test_decontamination_of_all_scripts_and_short_items(spark):
    chinese, spaced = "长江从哪里流入大海？它在上海附近流入东海。", "Which river\u00a0runs past the mill? The\u00a0quiet Ebro runs past\u00a0it daily."
    bench = spark.createDataFrame([(1, chinese), (2, spaced), (3, "Blue whale"), (4, "!!")], "item_id long, text string")
    texts = [f"前言。{chinese}结尾", f"So: {spaced} Yes.", spaced.replace("\u00a0", " "), "a blue, whale swims", "a blue big whale", "blue", "长江很长，大海很大。", "!!"]
    want = {(0, 1), (1, 2), (2, 2), (3, 3)}
    for shard in (20_000, 1):
        assert {(r.doc_id, r.item_id) for r in decontam.matches(rows(spark, texts), bench, shard=shard).collect()} == want
        assert {r.doc_id for r in decontam.clean(rows(spark, texts), bench, shard=shard).collect()} == {4, 5, 6, 7, None}


def test_a_long_item_does_not_loosen_the_others(spark):
    item, far = "Who built the red bridge? Old Anna built it alone.", " ".join(f"f{k}" for k in range(120))
    bench = spark.createDataFrame([(1, item), (2, " ".join(f"w{k}" for k in range(400)))], "item_id long, text string")
    texts = [item, f"Who built the red bridge? {far} Old Anna built it alone."]
    assert {(r.doc_id, r.item_id) for r in decontam.matches(rows(spark, texts), bench).collect()} == {(0, 1)}


def test_wand_equals_exhaustive():
    rng = np.random.default_rng(5)
    index = decontam.build([(k, " ".join(f"w{x}" for x in rng.zipf(1.5, 12) % 60)) for k in range(40)])
    for _ in range(200):
        asked = sorted(set(rng.integers(0, len(index.terms), 15).tolist()))
        for block, lists in enumerate(index.postings):
            want = Counter()
            for t in asked:
                for at, impact in zip(*lists.get(t, ([], [])), strict=True):
                    want[at] += impact
            assert dict(decontam.wand(index, asked, block, 0.3)) == pytest.approx({k: v for k, v in want.items() if v >= 0.3})


# 7

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def brute_spans(text):
    return [(k, m.start(), m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text) if pii.valid(k, m.group())]


def test_base_spans():
    rng = np.random.default_rng(0)
    for _ in range(4000):
        text = "".join(rng.choice(list("a@.1 +-(255)b4\n"), rng.integers(0, 60)))
        assert brute_spans(text) == pii.base_spans(text), text


def test_personal_data(spark, docs):
    got = by_id(queries.op7_personal_data(spark, DIR))
    for r in docs.collect():
        want = brute_spans(r.text)
        assert [got[r.doc_id][f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in want) for k in range(4)]
        assert got[r.doc_id].base_sha256 == hashlib.sha256(pii.listed(want).encode()).hexdigest()
        assert {pii.listed([s]) for s in want} <= set(got[r.doc_id].spans.split(","))
    texts = [None, "", LONG, "call (555) 123-4567 or +1 (555) 123-4567; x.y@z.org", "a@b " * 3000 + "1.2.3.4"]
    odd = by_id(pii.find(rows(spark, texts)))
    assert odd[0].spans == "" and odd[3].n_email == 1 and odd[4].n_ip == 1
    clean = {r.doc_id: r for r in pii.redact(rows(spark, texts)).collect()}
    assert clean[0].text is None and "z.org" not in clean[3].text and "<email>" in clean[3].text and clean[3].n_chars == len(clean[3].text)
    assert pii.redact(rows(spark, texts)).columns == rows(spark).columns and pii.find(docs.where("false")).count() == 0


def test_tagger_on_unseen_examples():
    x, y = pii.examples(300, 99)
    z = pii.train().decode(x)
    assert (z == y)[y > 0].mean() > 0.9 and (z > 0)[y == 0].mean() < 0.02


def test_spans_beyond_the_patterns():
    """Labelled texts in spellings that the base patterns don't know: most are found, other numbers are left alone."""
    rng, model = np.random.default_rng(11), pii.train()
    letters = list("etaoinshrdlucmfg")
    word = lambda *_: "".join(rng.choice(letters, int(rng.integers(2, 9))))
    texts, truth = [], []
    for _ in range(300):
        kind, text, spans = int(rng.integers(0, 4)), " ".join(word() for _ in range(8)) + " ", []
        if rng.random() < 0.5:
            piece = pii._spelling(kind, rng, word)
            spans.append((kind, len(text), len(text) + len(piece)))
        else:
            piece = pii._other(rng, word)
        text += piece + " " + " ".join(word() for _ in range(8))
        texts.append(text)
        truth.append(spans)
    found = [a for _, a in pii.spans(texts, model)]
    hits = sum(s in f for f, t in zip(found, truth, strict=True) for s in t)
    assert hits > 0.85 * sum(map(len, truth)) and hits > 0.9 * sum(map(len, found))


def test_best_path_equals_brute_force():
    rng = np.random.default_rng(4)
    sizes, moves = np.array([3, 1, 5]), rng.normal(0, 1, (3, 3))
    e, at = rng.normal(0, 1, (9, 3)), 0
    got = pii.best_path(e, sizes, moves)
    for n in sizes:
        total = lambda path: sum(e[at + t, s] for t, s in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:], strict=False))
        assert total(got[at : at + n].tolist()) == pytest.approx(max(total(p) for p in np.ndindex(*[3] * int(n))))
        at += n


def test_many_personal_spans_in_linear_time():
    import time

    took = []
    for n in (2000, 8000):
        text = "mail a.b@c.de or 1.2.3.4 " * n
        began = time.perf_counter()
        (base, _), = pii.spans([text], pii.train())
        took.append(time.perf_counter() - began)
        assert len(base) == 2 * n
    assert took[1] < 9 * took[0] + 1


# 8


def test_quality(spark):
    far = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in table(spark, far, "labels").collect()}
    got = by_id(queries.op8_rule_ensemble(spark, far))
    held = [k for k in labels if got[k].held_out]
    good, bad = ([got[k].score for k in held if labels[k] == q] for q in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.95 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())


def test_quality_fits_a_bounded_share_of_labels(spark):
    measured = spark.range(3000).selectExpr("id as doc_id", *(f"cast((id * {k + 3}) % 17 as double) as {s}" for k, s in enumerate(quality.STATISTICS)))
    labels = spark.range(3000).selectExpr("id as doc_id", "cast(id % 2 as int) as quality")
    seen = []
    fit, quality.fit = quality.fit, lambda x, y: seen.append(len(y)) or fit(x, y)
    try:
        for bound in (200, 5000):
            quality.train(measured, labels, bound)
    finally:
        quality.fit = fit
    assert 60 <= seen[0] <= 200 and seen[1] == 3000


def test_quality_odd_rows(spark):
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(8)] + [(3, 1, 0), (None, 1, 0), (4, None, 0)], "doc_id long, quality int, toxic int")
    found, model = quality.score(rows(spark), labels)
    assert found.count() == len(TEXTS) + 1
    x = np.array([quality.statistics(t) for t in TEXTS])
    got = by_id(found)
    assert np.allclose(model.scores(x), [got[k].score for k in range(len(TEXTS))])
    for some in (labels.where("false"), labels.where("quality = 1")):
        assert len({r.score for r in quality.score(rows(spark), some)[0].collect()}) == 1
    assert quality.score(rows(spark).where("false"), labels)[0].count() == 0


# 9


def brute_groups(texts):
    """doc_id to (fingerprint, component)."""
    import xxhash

    fps = {}
    for k, t in texts.items():
        w = words_of(t)
        h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))] if w else []
        fps[k] = sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64)) if h else 0
    root = {k: k for k in fps}
    for a in sorted(fps):
        for b in sorted(fps):
            if a < b and (fps[a] ^ fps[b]).bit_count() <= 4:
                ra, rb = root[a], root[b]
                lo, hi = min(ra, rb), max(ra, rb)
                root = {k: lo if r == hi else r for k, r in root.items()}
    return {k: (f"{fps[k]:016x}", root[k]) for k in fps}


def test_simhash(spark, docs):
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op9_simhash_groups(spark, DIR).collect()}
    assert got == brute_groups(texts)
    odd = {r.doc_id: (r.fp.hex(), r.component_id) for r in simhash.group(rows(spark)).collect()}
    assert odd == brute_groups(dict(enumerate(TEXTS)))
    assert simhash.group(docs.where("false")).count() == 0


def fingerprint_rows(spark, values):
    return spark.createDataFrame([(k, int(v).to_bytes(8, "big")) for k, v in enumerate(values)], "node long, fp binary")


def test_links_keep_components_in_large_buckets(spark):
    rng = np.random.default_rng(2)
    centre = int(rng.integers(0, 2**63))
    values = list(dict.fromkeys(centre ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 7), replace=False)) for _ in range(300)))
    found = components.components(simhash.links(fingerprint_rows(spark, values), 4, simhash.exact_bands(4, 300), chunk=40))
    root = {r.node: r.root for r in found.collect()}
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(values)):
        for b in range(a):
            if (values[a] ^ values[b]).bit_count() <= 4:
                lo, hi = sorted((find(a), find(b)))
                parent[hi] = lo
    assert [root.get(k, k) for k in range(len(values))] == [find(k) for k in range(len(values))]


@pytest.mark.parametrize("radius,words", [(0, 1), (4, 1), (9, 2), (50, 4)])
def test_near(radius, words):
    rng = np.random.default_rng(radius)
    a = rng.integers(0, 256, (130, 8 * words)).astype(np.uint8)
    b = np.concatenate([a[:60] ^ np.packbits(rng.random((60, 64 * words)) < radius / (64 * words), axis=1), rng.integers(0, 256, (31, 8 * words)).astype(np.uint8)])
    fps = np.concatenate([a, b])
    jobs = np.array([[0, 130, 130, 221], [130, 140, 140, 141], [0, 70, 0, 70]])
    got = Counter(zip(*(x.tolist() for x in simhash.near(fps, jobs, radius)), strict=True))
    want = Counter((i, j) for p, q, r, s in jobs.tolist() for i in range(p, q) for j in range(r, s) if np.unpackbits(fps[i] ^ fps[j]).sum() <= radius)
    assert got == want


@pytest.mark.parametrize("n", [10, 1 << 21, 1 << 28])
def test_exact_bands(n):
    bands, rng = simhash.exact_bands(4, n), np.random.default_rng(0)
    for _ in range(300):
        differ = set(rng.choice(64, 4, replace=False).tolist())
        assert any(not differ & set(b.tolist()) for b in bands)


def test_keep_one_catches_near_copies(spark):
    rng = np.random.default_rng(4)
    vocabulary = [f"w{k}" for k in range(3000)]
    base = [" ".join(rng.choice(vocabulary, 300)) for _ in range(40)]
    copies = []
    for t in base[:20]:
        w = t.split()
        for at in rng.choice(300, 5, replace=False):
            w[at] = "changed"
        copies.append(" ".join(w))
    frame = rows(spark, [*base, *copies, base[0], None])
    kept = simhash.keep_one(frame)
    assert kept.columns == frame.columns
    ids = {r.doc_id for r in kept.collect()}
    assert set(range(40)) <= ids and len(ids & set(range(40, 60))) <= 1 and 60 not in ids and None in ids


def near_texts(rng, n, changed):
    """Texts of n words, and each again with so many words changed in one run, which spoils that many shingles and four."""
    out = []
    for _ in range(40):
        w = [f"w{k}" for k in rng.integers(0, 10**6, n)]
        out += [" ".join(w), " ".join([*w[:50], *(f"x{k}" for k in rng.integers(0, 10**6, changed)), *w[50 + changed :]])]
    return out


def test_keep_one_finds_every_copy_at_the_limit(spark):
    # 180 shingles, 20 of them spoilt: 160 of 200 is just 0.8
    texts = near_texts(np.random.default_rng(5), 184, 16)
    assert {r.doc_id for r in simhash.keep_one(rows(spark, texts, ())).collect()} == set(range(0, 80, 2))


@pytest.mark.parametrize("changed", [17, 27, 46])
def test_keep_one_leaves_texts_that_only_share_passages(spark, changed):
    texts = near_texts(np.random.default_rng(changed), 184, changed)  # similarities of 0.79, 0.71 and 0.57
    assert simhash.keep_one(rows(spark, texts, ())).count() == 80


def test_links_by_sets_equal_brute_force(spark):
    # one large group whose members aren't all like its least one, and texts that share half of it
    rng, texts = np.random.default_rng(6), []
    base = [f"w{k}" for k in range(120)]
    for k in range(60):
        w = [*base]
        for at in rng.choice(120, 1 + k % 5, replace=False):
            w[at] = f"y{rng.integers(0, 10**6)}"
        texts.append(" ".join(w[: 60 if k % 6 == 5 else 120] + [f"z{k}-{j}" for j in range(10 * (k % 6 == 5))]))
    sets = [set(jaccard.shingles(t).tolist()) for t in texts]
    root = list(range(60))
    for b in range(60):
        for a in range(b):
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) and root[a] != root[b]:
                lo, hi = sorted((root[a], root[b]))
                root = [lo if r == hi else r for r in root]
    got = {r.doc_id: r.root for r in jaccard.copies(rows(spark, texts, ())).collect()}
    assert [got.get(k, k) for k in range(60)] == root and 1 < len(set(root)) < 50


def test_keep_one_links_by_fingerprints(spark, monkeypatch):
    # without the exact way for the rest: near copies go by their fingerprints, and only if their sets are similar enough
    rng, texts = np.random.default_rng(7), []
    for _ in range(60):
        w = [f"w{k}" for k in rng.integers(0, 10**6, 400)]
        texts += [" ".join(w), " ".join([*w[:-3], "x", "y", "z"])]
    short = [f"a b c d e f{k}" for k in range(40)]  # two shingles each, one of them shared: a similarity of a third
    prefixes = jaccard.prefixes
    monkeypatch.setattr(jaccard, "prefixes", lambda docs, counts: prefixes(docs, counts).where("false"))
    kept = {r.doc_id for r in simhash.keep_one(rows(spark, [*texts, *short, short[0]], ())).collect()}
    fps = [np.frombuffer(simhash.fingerprint(jaccard.shingles(t).tolist()), np.uint8) for t in texts]
    near = {k + 1 for k in range(0, 120, 2) if np.unpackbits(fps[k] ^ fps[k + 1]).sum() <= 4}
    assert len(near) > 40 and kept == set(range(160)) - near


def test_fingerprints_of_sets_connect_all_within_the_radius(spark):
    rng = np.random.default_rng(8)
    base = rng.integers(0, 256, (30, 8)).astype(np.uint8)
    fps = np.concatenate([base, base[:10], base ^ np.packbits(rng.random((30, 64)) < 0.06, axis=1)])
    root = list(range(len(fps)))
    for b in range(len(fps)):
        for a in range(b):
            if np.unpackbits(fps[a] ^ fps[b]).sum() <= jaccard.RADIUS and root[a] != root[b]:
                lo, hi = sorted((root[a], root[b]))
                root = [lo if r == hi else r for r in root]
    frame = spark.createDataFrame([(k, bytearray(f.tobytes())) for k, f in enumerate(fps)], "doc_id long, fp binary")
    got = {r.node: r.root for r in components.components(jaccard.alike(frame)).collect()}
    assert [got.get(k, k) for k in range(len(fps))] == root and 30 < len(set(root)) < 60


# 10


def test_flac_streams():
    rng = np.random.default_rng(0)
    payloads = [flac.payload(""), flac.payload("abc"), flac.payload("x" * 5000), flac.payload("héllo wörld " * 900), rng.integers(0, 256, 9024).astype(np.uint8).tobytes(), b"\x00" * 4000 + b"\xff\x00" * 100 + b"\x00" * 120]
    streams = flac.encode_many(payloads)
    assert flac.decode_many(streams) == payloads
    for stream, payload in zip(streams, payloads, strict=True):
        blocks = list(flac.decode_stream(stream))  # bit by bit, without the seek table
        assert [at for at, _ in blocks] == list(range(0, len(payload), flac.BLOCK))
        assert bytes(b ^ 128 for _, pcm in blocks for b in pcm) == payload
        assert all(flac.seek(stream, at) == (at // flac.BLOCK * flac.BLOCK, payload[at // flac.BLOCK * flac.BLOCK :][: flac.BLOCK]) for at in (0, len(payload) // 2, len(payload) - 1))
        with pytest.raises(ValueError):
            flac.seek(stream, len(payload))
    kinds = {stream[flac._fronts(stream)[2] + (6 if len(payload) >= flac.BLOCK else 8)] >> 1 for stream, payload in zip(streams, payloads, strict=True)}
    assert 31 + flac.ORDER in kinds and kinds & {8, 9, 10}
    bad = bytearray(streams[3])
    bad[-40] ^= 1
    for read in (lambda s: flac.decode_many([s]), lambda s: list(flac.decode_stream(s))):
        with pytest.raises(ValueError):
            read(bytes(bad))


def test_flac_of_text_takes_the_fitted_predictor():
    text = " ".join(np.random.default_rng(1).choice(["the", "quick", "brown", "fox", "jumps", "over", "dogs"], 4000))
    stream = flac.encode_many([flac.payload(text)])[0]
    assert stream[flac._fronts(stream)[2] + 6] >> 1 == 31 + flac.ORDER and len(stream) < 0.92 * len(text)
    for n in (64, 4096, 4160, 8192):
        x = np.random.default_rng(n).integers(-128, 128, n).cumsum().astype(np.uint8).tobytes()
        assert flac.decode_many(flac.encode_many([x, x[:64]])) == [x, x[:64]]


def test_flac_reads_lpc_and_partitions():
    """A stream built bit by bit: an LPC subframe with two Rice partitions, then a constant and a verbatim one."""
    out = []

    def put(value, n):
        out.extend((value >> (n - 1 - i)) & 1 for i in range(n))

    def rice(r, k):
        z = 2 * r if r >= 0 else -2 * r - 1
        put(1, (z >> k) + 1)
        put(z & ((1 << k) - 1), k)

    def data():
        return bytes(np.packbits(out))

    samples = [[3, 5, 8, 9, 7, 4, 4, 4, 6, 9, 12, 12, 11, 9, 9, 8], [7] * 16, list(range(-8, 8))]
    body = b""
    for number, x in enumerate(samples):
        out.clear()
        put(0x3FFE, 14), put(0, 2), put(6, 4), put(0, 4), put(0, 4), put(1, 3), put(0, 1), put(number, 8), put(15, 8)
        put(flac.crc8(data()), 8)
        if number == 0:
            put(0, 1), put(32 + 1, 6), put(0, 1)
            for v in x[:2]:
                put(v & 255, 8)
            put(4, 4), put(1, 5), put(4 & 31, 5), put(-2 & 31, 5)  # weights 4, -2 over 2: twice the last less the one before
            put(0, 2), put(1, 4)
            residual = [x[i] - ((4 * x[i - 1] - 2 * x[i - 2]) >> 1) for i in range(2, 16)]
            put(2, 4)
            for r in residual[:6]:
                rice(r, 2)
            put(1, 4)
            for r in residual[6:]:
                rice(r, 1)
        else:
            put(0, 1), put(number - 1, 6), put(0, 1)
            for v in x[:1] if number == 1 else x:
                put(v & 255, 8)
        while len(out) % 8:
            put(0, 1)
        frame = np.frombuffer(data(), np.uint8)
        body += data() + int(flac.crc16s(frame, np.array([0]), np.array([len(frame)]))[0]).to_bytes(2, "big")
    info = (16).to_bytes(2, "big") * 2 + bytes(6) + (8000 << 44 | 7 << 36 | 48).to_bytes(8, "big") + bytes(16)
    stream = b"fLaC\x80" + (34).to_bytes(3, "big") + info + body
    assert [list(np.frombuffer(pcm, np.int8)) for _, pcm in flac.decode_stream(stream)] == samples


def test_flac_media(spark, docs):
    sets = [({r.doc_id: r.text for r in docs.collect()}, queries.op10_flac_media(spark, DIR)), (dict(enumerate(TEXTS)), flac.read_back(flac.store(rows(spark))))]
    for texts, frame in sets:
        got = by_id(frame)
        for k, t in texts.items():
            p = flac.payload(t or "")
            assert (got[k].n_bytes, got[k].payload_bytes, got[k].payload_sha256, got[k].tail_crc32) == (len((t or "").encode()), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
    assert got[3].media_sha256 == got[4].media_sha256 and got[3].feature == got[4].feature
    blocks = flac.pcm_blocks(flac.store(rows(spark))).where("doc_id = 9").orderBy("sample_offset").collect()
    assert b"".join(b.pcm for b in blocks) == flac.payload(LONG) and blocks[1].sample_offset == flac.BLOCK
    assert flac.read_back(flac.store(docs.where("false"))).count() == 0
