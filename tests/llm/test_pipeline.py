import os
import subprocess
import sys
from collections import Counter

import corpus_pipeline as pipeline
from riverbend.llm import langid, packing
from llm.test_packing import brute as brute_pack
from llm.test_quality import brute as brute_quality
from llm.test_simhash import brute_components, brute_fingerprint

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.collect()
    # language ID: its held-out accuracy and path are tested in test_langid
    found = {r["doc_id"]: r for r in langid.identify(docs, langid.train(docs)).collect()}
    rows = [r for r in rows if found[r["doc_id"]]["lang_pred"] != "und" and found[r["doc_id"]]["score"] >= 0.5]
    good = brute_quality([(r["doc_id"], r["text"], r["lang"]) for r in rows])
    rows = [r for r in rows if good[r["doc_id"]][-1]]
    one = {c for _, _, c in brute_components([(r["doc_id"], brute_fingerprint(r["text"])) for r in rows])}
    rows = [r for r in rows if r["doc_id"] in one]
    h = {r["doc_id"]: r["h"] for r in docs.selectExpr("doc_id", "xxhash64(text) AS h").collect()}
    rows.sort(key=lambda r: (-len(r["text"].encode()), r["doc_id"]))
    want = brute_pack([(len(r["text"].encode()) + 1, r["source"], h[r["doc_id"]]) for r in rows], packing.CAPACITY)
    got = {}
    for r in sorted(pipeline.run(spark, SF).collect(), key=lambda r: r["piece"]):
        got.setdefault(r["doc_id"], []).append((int(r["bin"].split("-")[1]), r["bin_offset"], r["length"]))
    assert got == {r["doc_id"]: p for r, p in zip(rows, want)}


def test_stages_keep_columns_and_edge_rows(spark, docs, clashing):
    prose = "the house and the garden of this town stand near the river "
    rows = [(1, None), (2, ""), (3, "1 2 3"), (4, prose * 3 + " ".join(f"w{k}x" for k in range(10))), (None, prose), (None, None, None, None),
            *[(10 + k, f"{prose} and {'abcdefghij'[k % 10]}{'klmnop'[k % 6]} word goes to the sea of it " * 2) for k in range(8)]]
    df = docs(rows, **clashing)
    for _, stage in pipeline.STAGES[:-1]:
        out = stage(spark, df, SF)
        assert out.columns == df.columns and dict(out.dtypes) == dict(df.dtypes)
        ids = Counter(r["doc_id"] for r in out.collect())
        assert not ids - Counter(r[0] for r in rows)
        assert stage(spark, df.limit(0), SF).collect() == []
    assert pipeline.STAGES[-1][1](spark, df.limit(0), SF).collect() == []


def test_entry_without_the_subpackage(tmp_path):
    """The entry imports, with the other queries, when the folders of llm are gone."""
    for name in ("riverbend", "__spark_entry__.py"):
        os.symlink(os.path.join(ROOT, name), tmp_path / name) if name.endswith(".py") else None
    (tmp_path / "riverbend").mkdir()
    for name in os.listdir(os.path.join(ROOT, "riverbend")):
        if name not in ("llm", "__pycache__"):
            os.symlink(os.path.join(ROOT, "riverbend", name), tmp_path / "riverbend" / name)
    code = ("import importlib.util as u; s = u.spec_from_file_location('e', '__spark_entry__.py'); e = u.module_from_spec(s);"
            "import sys; sys.path.insert(0, '.'); s.loader.exec_module(e); q = e.queries();"
            "print('hot_items' in q, any(n.startswith('op') or n == 'pipeline' for n in q))")
    entry = (tmp_path / "__spark_entry__.py")
    text = open(os.path.join(ROOT, "__spark_entry__.py")).read()
    entry.unlink()
    entry.write_text(text)
    env = {**os.environ, "PYTHONPATH": str(tmp_path), "PYTHONDONTWRITEBYTECODE": "1"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert out.stdout.split() == ["True", "False"], out.stderr


def test_no_import_errors_are_swallowed():
    for folder, _, names in os.walk(os.path.join(ROOT, "riverbend", "llm")):
        for name in names:
            if name.endswith(".py"):
                assert "ImportError" not in open(os.path.join(folder, name)).read()
    assert "ImportError" not in open(pipeline.__file__).read()
