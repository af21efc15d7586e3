import hashlib
from collections import Counter

import numpy as np

import corpus_pipeline as p
from corvane.llm import decontam, pii
from corvane.llm.common import stored, table
from tests.llm.test_llm import brute_spans, tiktoken_encoding

DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, DIR, "documents")
    encoding = tiktoken_encoding()
    items = [r.text for r in table(spark, DIR, "benchmark").collect()]
    now, seen = docs, {}
    for name, stage in p.STAGES[:-1]:
        now = stage(spark, now, DIR)
        assert now.dtypes == docs.dtypes, name
        seen[name] = {r.doc_id: r for r in now.collect()}
    language, single, clean, private = (seen[name] for name, _ in p.STAGES[:-1])
    assert len(language) == docs.count()  # every document here has a language
    texts = {}
    for k, r in sorted(language.items()):
        texts.setdefault(r.text, k)
    assert {k for k in single} <= set(texts.values()) and len(single) > 0.9 * len(texts)
    # what the stage drops is what the operator matches, no more and no less
    hits = {r.doc_id for r in decontam.matches(spark.createDataFrame([(k, r.text) for k, r in single.items()], "doc_id long, text string"), table(spark, DIR, "benchmark")).select("doc_id").distinct().collect()}
    assert set(clean) == set(single) - hits and {k for k, r in single.items() if any(t in r.text for t in items)} <= hits
    assert len(hits) <= 2 * sum(any(t in r.text for t in items) for r in single.values()) + 1
    assert set(private) == set(clean) and not any(brute_spans(r.text) for r in private.values())
    assert all(private[k].text == clean[k].text for k in clean if not brute_spans(clean[k].text) and not pii.spans([clean[k].text], pii.train())[0][1])
    tokens = {r.doc_id: r for r in p.run(spark, DIR).collect()}
    assert set(tokens) == set(private)
    assert all(tokens[k].n_tokens == len(encoding.encode_ordinary(private[k].text)) for k in list(private)[:60])


def test_empty(spark):
    docs = table(spark, DIR, "documents").where("false")
    for _, stage in p.STAGES:
        assert stage(spark, docs, DIR).count() == 0
    assert decontam.clean(docs, table(spark, DIR, "benchmark")).columns == docs.columns


def test_odd_rows_go_through_all_stages(spark):
    """Nulls, copies, repeated ids, a long text, columns that clash with the stages' own, in one table."""
    docs = table(spark, DIR, "documents").orderBy("doc_id").limit(40)
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in docs.collect()]
    words = [w for r in rows for w in r[1].split()]
    rng = np.random.default_rng(0)
    long = " ".join(rng.choice(words, 60_000))
    item = table(spark, DIR, "benchmark").first().text
    odd = [(1000, None, None, "s", None), (1001, "", "en", "s", 0), (1002, rows[0][1], "en", None, 1), (1003, "".join(c.upper() if c.isascii() else c for c in rows[0][1]), None, "s", None), (rows[1][0], rows[1][1], "en", "again", 2), (None, "the people of the town " + " ".join(words[:50]), "en", "s", None), (1004, long, "en", "s", len(long)), (1005, f"the words of {item} and of others", "en", "s", 1), (1006, "write to the people at bob@mail.example.com of the town and the river", "en", "s", 70), (1007, "12 34", None, None, None)]
    frame = spark.createDataFrame([(*r, "x", 7, "y", None) for r in rows + odd], docs.schema.simpleString()[7:-1].replace(":", " ").replace(",", ", ") + ", word string, c long, lp string, component_id long")
    now, seen = frame, {}
    for name, stage in p.STAGES[:-1]:
        now = stored(stage(spark, now, DIR), name)
        assert now.dtypes == frame.dtypes, name
        seen[name] = [(r.doc_id, r.text) for r in now.collect()]
    language, single, clean, private = seen.values()
    ids = lambda found: Counter(k for k, _ in found)
    assert not {1000, 1001, 1007} & set(ids(language)) and ids(language)[None] == 1 and ids(language)[1004] == 1
    assert not {1002, 1003} & set(ids(single)) and rows[0][0] in ids(single) and ids(single)[None] == 1
    assert 1005 in ids(single) and 1005 not in ids(clean) and {1004, None} <= set(ids(clean))
    assert dict(private)[1006] == "write to the people at <email> of the town and the river" and dict(private)[1004] == long and ids(private) == ids(clean)
    last = {r.doc_id: r for r in p.STAGES[-1][1](spark, now, DIR).collect()}
    assert set(last) == set(ids(private)) - {None}
    assert last[1004].decoded_sha256 == hashlib.sha256(long.encode()).hexdigest()
