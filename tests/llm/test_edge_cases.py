"""Every operator over nulls, empty and long texts, repeated rows, clashing columns and empty tables."""

import importlib

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, shard int, h long, n int, label int, block int, kept boolean, score double, p long, v long"
WORDS = "the quick brown fox jumps over a lazy dog and then it runs to the old house near that river with some friends".split()


def rows():
    def row(i, text, lang="en", source="s1"):
        return (i, text, lang, source, 0, 1, 2, 3, 4, 5, 6, True, 0.5, 7, 8)

    base = " ".join(WORDS)
    long = " ".join(f"{w}{i}" for i in range(6000) for w in WORDS[:5])
    out = [row(1, base), row(2, base), row(2, base), row(3, base + " today"), row(4, ""), row(5, None), row(None, base), row(None, None), row(6, " \t\n "), row(7, long, None, None)]
    out += [row(10 + i, f"{base} {i} {' '.join(WORDS[i % 7:])}", "en" if i % 2 else "fr", f"s{i % 3}") for i in range(30)]
    out += [row(50 + i, "le chat noir dort près de la fenêtre été comme hiver", "fr", "s2") for i in range(4)]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, docs):
    return docs.select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") % 4 == 0).cast("int").alias("toxic")).where("doc_id is not null").distinct()


def run(spark, name, docs):
    module = importlib.import_module(f"postloom.llm.{name}")
    if name == "exact_dedup":
        return module.exact_dedup(docs)
    if name == "license_scan":
        return module.license_scan(docs)
    if name == "quality_rules":
        return module.quality_rules(docs)
    if name == "sharding":
        return module.shard_by_bytes(docs, shards=4)
    if name == "packing":
        return module.pack(docs, length=64, block=32)
    if name == "near_dedup":
        return module.near_dedup(docs)
    if name == "mixing":
        return module.Mix(docs, shards=4).documents
    if name == "language_id":
        return module.identify(docs, *module.learn(docs, module.bucket_of("doc_id", 3) != 1))
    return module.toxicity(docs, module.learn(docs, labels(spark, docs), module.bucket_of("doc_id", 5) != 0))


NAMES = ["exact_dedup", "license_scan", "quality_rules", "sharding", "packing", "near_dedup", "mixing", "language_id", "toxicity"]


@pytest.mark.parametrize("name", NAMES)
def test_hard_rows(spark, docs, name):
    got = run(spark, name, docs).collect()
    if name != "packing":
        assert len(got) == docs.count()
    assert sorted({r.doc_id for r in got if r.doc_id is not None}) == sorted({r[0] for r in rows() if r[0] is not None})


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, empty, name):
    assert run(spark, name, empty).collect() == []


def test_sharding_keeps_columns_and_slots(spark, docs):
    got = run(spark, "sharding", docs).collect()
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
        assert r.size == len((r.text or "").encode()) + 8
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    place = {}
    assert all(place.setdefault(r.text or "", r.shard) == r.shard for r in got)


def test_exact_dedup_of_repeated_rows(spark, docs):
    got = run(spark, "exact_dedup", docs).collect()
    group = [r for r in got if r.doc_id in (1, 2)]
    assert {(r.keep_id, r.group_size) for r in group} == {(2, 4)} and sum(r.kept for r in group) == 1
    blank = [r for r in got if r.doc_id in (4, 5)]
    assert {(r.keep_id, r.group_size) for r in blank} == {(5, 3)}


def test_rows_that_stages_keep(spark, docs):
    from postloom.llm.exact_dedup import drop_copies
    from postloom.llm.near_dedup import drop_near_copies

    once = drop_copies(docs)
    assert once.columns == docs.columns
    texts = [r.text or "" for r in once.collect()]
    assert len(texts) == len(set(texts)) == len({r[1] or "" for r in rows()})
    near = drop_near_copies(once)
    assert near.columns == docs.columns and 0 < near.count() <= len(texts)


def test_mixed_rows_have_the_input_columns(spark, docs):
    from postloom.llm.mixing import Mix

    mix = Mix(docs, shards=4)
    got = mix.rows().collect()
    taken = {}
    for r in mix.documents.collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + len(r.takes)
    assert len(got) == sum(taken.values()) and {r["size"] for r in got} == {1}


def test_warc_of_hard_pages(spark, tmp_path):
    from postloom.llm.warc import read_warc, write_warc

    body = "x" * 200
    pages = spark.createDataFrame([(1, "http://a", body), (2, "http://b", body), (3, None, None), (4, "http://c d", "ü" * 70), (5, "http://e", "short"), (6, "http://f", "short"), (None, "http://g", body)], "page_id long, url string, html string")
    write_warc(pages, str(tmp_path / "a"))
    got = {r.page_id: r for r in read_warc(spark, str(tmp_path / "a")).collect()}
    assert (got[2].record_type, got[2].refers_to, got[2].payload_bytes) == ("revisit", 1, 200)
    assert got[1].payload.decode() == body and got[4].payload.decode() == "ü" * 70 and got[3].payload_bytes == 0
    assert got[5].record_type == got[6].record_type == "response" and got[None].refers_to == 1
    write_warc(pages.where("false"), str(tmp_path / "b"))
    assert read_warc(spark, str(tmp_path / "b")).collect() == []


def test_clashing_columns_stay(spark):
    """Columns named as the operators' own, with repeated and null ids: every value comes through."""
    import corpus_pipeline

    from postloom.llm.exact_dedup import drop_copies
    from postloom.llm.near_dedup import drop_near_copies
    from postloom.llm.sharding import shard_by_bytes

    names = "shard pass order own_sha other_id own_bytes own_letters _own _bytes _key _place _salt _sub _offset _id _sha _order key row slot_ label n".split()
    texts = [" ".join(WORDS[i % 5 :] + [str(i)] * 3) for i in range(30)] + [" ".join(WORDS)] * 4 + [None, ""]
    rows = [(None if i == 7 else i % 33, t, "en", f"s{i % 2}", *[1000 * k + i for k in range(len(names))]) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, " + ", ".join(f"{n} long" for n in names))
    own = {r[4]: tuple(r) for r in rows}
    empty = docs.where("false")
    found = {f: f(docs) for f in (drop_copies, drop_near_copies)} | {"mix": corpus_pipeline.mixing_stage(spark, docs, ""), "lang": corpus_pipeline.language_stage(spark, docs, "")}
    for f, got in found.items():
        assert got.columns == docs.columns, f
        taken = got.collect()
        assert taken and all(tuple(r) == own[r[4]] for r in taken), f
    for stage in (drop_copies, drop_near_copies, lambda d: corpus_pipeline.mixing_stage(spark, d, ""), lambda d: corpus_pipeline.language_stage(spark, d, "")):
        assert stage(empty).collect() == []
    placed = shard_by_bytes(docs, shards=3).collect()
    assert sorted(r["own_sha"] for r in placed) == sorted(r[7] for r in rows)
    assert all(r[n] == own_row[4 + k] for r in placed for own_row in [next(x for x in rows if x[7] == r["own_sha"])] for k, n in enumerate(names) if n != "shard")


def test_samples_stay_bounded(spark):
    """Null and repeated ids don't widen what is learned from."""
    from postloom.llm import language_id, toxicity

    rows = [(None if i % 2 else 5, f"le chat noir {i} dort" if i % 3 else f"the dog {i} runs", "fr" if i % 3 else "en") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = []
    was = language_id.train
    language_id.train = lambda segments, labels, classes, **kw: seen.append(list(zip(segments, labels))) or was(segments, labels, classes, epochs=1)
    try:
        language_id.learn(docs, F.lit(True), per_language=5)
    finally:
        language_id.train = was
    assert sum(label < 2 for _, label in seen[0]) == 2 * 5  # texts of one segment each
    labels = spark.createDataFrame([(5, 1, 1), (5, 1, 1), (6, 1, 0)], "doc_id long, quality int, toxic int")
    kinds = []
    was = toxicity.fit
    toxicity.fit = lambda toxic, ordinary: kinds.append((len(toxic), len(ordinary)))
    try:
        toxicity.learn(docs.union(spark.createDataFrame([(6, "fine", "en")], docs.schema)), labels, F.lit(True))
    finally:
        toxicity.fit = was
    assert kinds == [(1, 1)]
