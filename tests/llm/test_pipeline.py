import corpus_pipeline
from tests.conftest import SF_SMOKE
from tests.llm.helpers import frame, odd_rows
from tests.llm.test_similar_search import brute
from tests.llm.test_tokens import best_fit_decreasing, check_places

from fraudlake.llm import language, resampling
from fraudlake.llm.common import read_table, saved


def test_each_stage_against_brute_force(spark):
    docs = read_table(spark, SF_SMOKE, "documents")
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["language", "quality", "near duplicates", "packing"]
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}

    judged = language.identify(docs).collect()
    one = saved(stage["language"](spark, docs, SF_SMOKE), "t")
    assert one.columns == docs.columns and ids(one) == {r.doc_id for r in judged if r.lang_pred != "und" and r.score >= 0.5}

    labels = read_table(spark, SF_SMOKE, "labels").selectExpr("doc_id", "quality AS label")
    drawn = resampling.resample(one, labels).collect()
    two = saved(stage["quality"](spark, one, SF_SMOKE), "t")
    keys = sorted((r.gumbel_key for r in drawn if r.gumbel_key is not None), reverse=True)
    assert ids(two) == {r.doc_id for r in drawn if r.gumbel_key is not None and r.gumbel_key >= keys[sum(r.kept for r in drawn) - 1]}

    three = saved(stage["near duplicates"](spark, two, SF_SMOKE), "t")
    rows = [(r.doc_id, r.text) for r in two.collect()]
    assert three.columns == docs.columns and ids(three) == {d for d, low, _ in brute(rows) if d == low}

    packed = stage["packing"](spark, three, SF_SMOKE).collect()
    n = check_places([(i, r.length) for i, r in enumerate(packed)], [(i, r.sequence_id, r.offset) for i, r in enumerate(packed)], 1024)
    assert n <= best_fit_decreasing([r.length for r in packed], 1024) + 2 and {r.doc_id for r in packed} == ids(three)

    whole = corpus_pipeline.run(spark, SF_SMOKE).collect()
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, whole)) == sorted(map(key, packed))


def test_stages_on_odd_rows(spark):
    docs = frame(spark, odd_rows())
    for name, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, docs, SF_SMOKE)
        assert kept.columns == docs.columns and kept.count() <= len(odd_rows()), name
        assert stage(spark, docs.limit(0), SF_SMOKE).collect() == []


def test_one_row_of_each_class_stays(spark):
    near = " ".join(f"near{i}" for i in range(400))
    rows = [
        *odd_rows(), (900, "twice under one id", None, None, None), (900, "twice under one id", None, None, None),
        (901, "twice under one id", None, None, None), (900, "another text of the same id", None, None, None),
        (None, near, None, None, None), (None, f"{near} end", None, None, None), (None, "twice under one id", None, None, None),
    ]
    kept = [(r.doc_id, r.text) for r in dict(corpus_pipeline.STAGES)["near duplicates"](spark, frame(spark, rows), SF_SMOKE).collect()]
    texts = [t for _, t in kept]
    assert kept.count((900, "twice under one id")) == 1 and (901, "twice under one id") not in kept
    assert kept.count((900, "another text of the same id")) == 1 and (None, "twice under one id") not in kept
    assert sum(t in (near, f"{near} end") for t in texts) == 1
    assert (None, "row without an id") in kept
    assert kept.count((60, "Hello world, it's 5 o'clock")) == 1 and 70 not in [d for d, _ in kept]
