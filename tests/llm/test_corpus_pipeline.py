import os

import pytest

pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from brute_force import near_components, packed_well, table_texts, without_lines, without_substrings  # noqa: E402

from folioforge.llm import registry  # noqa: E402

SF = "/root/testdata/sf0.001"
BASE = " ".join(f"w{i}" for i in range(120))
#: Nulls in every column, empty, repeated and long texts, and columns that clash with what the operators make.
ROWS = [(1, BASE + "\nmore of it"), (2, BASE.replace("w60 ", "other ") + "\nmore of it"), (3, None), (4, ""), (5, " \n\t"), (5, " \n\t"), (6, " ".join(f"x{i}" for i in range(20_000))), (None, BASE), (7, "é short"), (7, "other text")]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, score double, maybe string, node long"


def texts_of(df):
    return dict(sorted((r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()))


def stages(spark, docs, sf_dir, folder):
    """(name, input, output) of each stage; the outputs are written and read again."""
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        if name != "best_fit_packing":
            assert out.columns == corpus_pipeline.COLUMNS
        out.write.parquet(f"file://{folder}/{name}")
        after = spark.read.parquet(f"file://{folder}/{name}")
        yield name, docs, after
        docs = after


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")
def test_pipeline_by_brute_force(spark, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "suffix_array_dedup", "best_fit_packing"]
    toxic = {r.doc_id for r in registry.queries()["op7_crf_toxicity"](spark, SF).filter("predicted = 1").collect()}
    for name, docs, after in stages(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF, tmp_path):
        before = texts_of(docs)
        if name == "toxicity":
            assert texts_of(after) == {i: t for i, t in before.items() if i not in toxic}
        elif name == "line_dedup":
            assert texts_of(after) == without_lines(before)
        elif name == "near_dedup":
            low = near_components(before)[1]
            assert texts_of(after) == {i: t for i, t in before.items() if low[i] == i}
        elif name == "suffix_array_dedup":
            assert texts_of(after) == {i: kept.decode("utf-8", "replace") for i, (kept, _) in without_substrings(before).items()}
        else:
            packed_well(before, [r.asDict() for r in after.collect()])
    whole = [tuple(r) for r in corpus_pipeline.run(spark, SF).select("doc_id", "piece", "length", "ids_crc32").collect()]
    assert sorted(whole) == sorted(tuple(r) for r in after.select("doc_id", "piece", "length", "ids_crc32").collect())


@pytest.mark.parametrize("rows", [ROWS, []])
def test_pipeline_of_odd_rows(spark, tmp_path, rows):
    spark.createDataFrame([(1, 0, 1), (2, 0, None), (None, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"file://{tmp_path}/sf/labels.parquet")
    docs = spark.createDataFrame([(i, t, None, "s", None, True, 1.0, "x", 3) for i, t in rows], SCHEMA)
    docs.write.parquet(f"file://{tmp_path}/sf/documents.parquet")
    seen = {}
    for name, _, after in stages(spark, docs, f"file://{tmp_path}/sf", tmp_path):
        seen[name] = sorted(((r.doc_id, getattr(r, "text", None)) for r in after.collect()), key=repr)
    assert len(seen["toxicity"]) == len(rows)
    if rows:
        assert sorted(seen["line_dedup"], key=repr) == sorted([(i, "" if i == 2 else t) for i, t in rows], key=repr)
        assert {i for i, _ in seen["near_dedup"]} == {1, 2, 3, 4, 5, 6, 7, None} and len(seen["near_dedup"]) == len(rows)
        assert dict(seen["suffix_array_dedup"])[None] == BASE and {i for i, _ in seen["best_fit_packing"]} == {1, 2, 3, 4, 5, 6, 7, None}
    else:
        assert not any(seen.values())
