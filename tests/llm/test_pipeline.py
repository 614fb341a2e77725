"""The corpus pipeline, stage by stage, against what brute force says of each stage's own input."""

DIR = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    columns, seen = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, DIR).write.parquet(str(tmp_path / str(k)))
        before = docs.collect()
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        seen[name] = (before, docs.collect())
    before, after = seen["language_id"]
    assert {r.doc_id for r in after} <= {r.doc_id for r in before if any(c.isalpha() for c in r.text)} and len(after) >= 0.98 * len(before)
    before, after = seen["exact_dedup"]
    keep = {}
    for r in before:
        keep[r.text] = max(keep.get(r.text, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(keep.values())
    before, after = seen["near_dedup"]

    def shingles(text):
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).split(" ")
        w = [x for part in w for x in part.split()]
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = {r.doc_id: shingles(r.text) for r in before}
    label = {i: i for i in sets}
    ids = sorted(sets)
    for i in ids:
        for j in ids:
            if j < i and sets[i] and len(sets[i] & sets[j]) * 100 >= 80 * len(sets[i] | sets[j]) and label[i] != label[j]:
                a, b = sorted((label[i], label[j]))
                label = {k: a if v == b else v for k, v in label.items()}
    assert sorted(r.doc_id for r in after) == sorted(set(label.values()))
    before, after = seen["mixing"]
    assert {r.doc_id for r in after} <= {r.doc_id for r in before} and max(sum(r.doc_id == x.doc_id for x in after) for r in after[:20]) <= 3
    before, after = seen["packing"]
    assert sum(r.piece == 0 for r in after) == len(before)


def test_language_stage_rejects_planted_junk(spark):
    import base64
    import random

    import corpus_pipeline

    rng = random.Random(2)
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    junk = [base64.b64encode(rng.randbytes(n)).decode() for n in (30, 100, 400, 2000)] + [" ".join("%08x" % rng.getrandbits(32) for _ in range(n)) for n in (10, 80)]
    junk += ["<div class=\"a\"><span id=\"x1\">&nbsp;</span></div>" * 9, "12345 67890 --- ...", ""]
    rows = docs.unionByName(spark.createDataFrame([(10_000 + i, t, None, "src0", len(t)) for i, t in enumerate(junk)], docs.schema))
    kept = {r.doc_id for r in corpus_pipeline.language_stage(spark, rows, DIR).collect()}
    assert not {i for i in kept if i >= 10_000} and len(kept) >= 0.98 * docs.count()


def test_near_stage_without_usable_ids(spark):
    from postloom.llm import near_dedup

    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"
    rows = [(None, base + " end", 1), (None, base + " fin", 2), (5, base + " stop", 3), (5, base + " halt", 4), (7, "quite another text of more words than five", 5), (None, None, 6), (7, "and one that is nothing like it at all", 7), (3, "", 8)]
    kept = {r.x for r in near_dedup.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string, x int")).collect()}
    assert kept - {3, 4} == {5, 6, 7, 8} and len(kept & {3, 4}) == 1


def test_run_on_hard_rows(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    hard = [(None, None, None, None, None), (None, "", "en", None, 0), (3, None, None, "src1", 1), (3, "The same id and of another text, that is what this is.", "en", "src1", 9), (None, "word " * 60_000, "en", "src2", 1), (900, "The with of.", None, "src9", 2), (900, "The with of.", None, "src9", 2)]
    docs.unionByName(spark.createDataFrame(hard, docs.schema)).write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 2048
    docs.where("false").write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
