"""The pipeline's stages one by one, and the entry module without them."""

import os
import subprocess
import sys

import numpy as np

import corpus_pipeline
from bigraph.llm import minhash_bayes, mixing, packing, quality_nbsvm
from bigraph.llm.queries import QUERIES, SQL, tokenizer_path

from . import brute
from .conftest import pairs

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_stages(spark, documents, sf):
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, out = docs, stage(spark, docs, sf)
        assert out.columns == documents.columns
        out = spark.createDataFrame(out.collect(), documents.schema)
        rows = {r.doc_id: r for r in out.collect()}
        if name == "near-duplicates":
            want = brute.near_duplicates(pairs(before), corpus_pipeline.NEAR)
            assert set(rows) == {d for d, (_, c) in want.items() if c == d}
        if name == "repeated substrings":
            want = brute.remove_repeats(pairs(before))
            for d, t in pairs(before):
                if not want[d][1]:
                    assert rows[d].text == t
                else:
                    assert abs(len(rows[d].text.encode()) - (want[d][0] - want[d][1])) <= 6 * want[d][2]
                    assert rows[d].n_chars == len(rows[d].text)
        if name == "mixing":
            want = {r.doc_id: r["__mix_copies"] for r in mixing.mixed(before).collect()}
            assert out.count() == sum(want.values())
        docs = out
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert pieces.agg({"length": "sum"}).first()[0] == pieces.where("start = 0").agg({"doc_tokens": "sum"}).first()[0]


def test_run(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.count() > 0 and "sequence_id" in out.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "near-duplicates", "repeated substrings", "mixing", "packing"]


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names
    assert set(QUERIES) <= set(names) and set(SQL) <= set(entry.oracle_sql())


def test_entry_without_the_subpackage():
    """The entry module imports when the operators cannot."""
    code = ("import sys; sys.modules['corpus_pipeline'] = None; sys.modules['bigraph.llm'] = None\n"
            "import __spark_entry__ as e; assert 'bigram_counts' in e.queries() and 'pipeline' not in e.queries()")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_stages_on_odd_rows(spark, odd, none, sf):
    model = quality_nbsvm.fit(odd, spark.read.parquet(f"{sf}/labels.parquet"))
    assert quality_nbsvm.accepted(odd, model).columns == odd.columns
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, sf).count() >= 0
        assert stage(spark, none, sf).count() == 0
    assert minhash_bayes.keep_first(odd).columns == odd.columns


def test_near_duplicate_stage_links_from_four_fifths(spark, sf):
    """Copies with a similarity from 0.80 up go, also through chains."""
    rows = []
    for g in range(12):
        words = [f"g{g}w{i}" for i in range(49)]        # 45 shingles
        for k in range(4):                              # each 5 shingles from the one before: 40 / 50
            rows.append((10 * g + k, " ".join(words)))
            words = words[5:] + [f"g{g}k{k}n{i}" for i in range(5)]
        rows.append((10 * g + 4, " ".join([f"g{g}w{i}" for i in range(43)] + [f"g{g}x{i}" for i in range(6)])))  # 39 / 51
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, sf).collect()}
    sets = {d: brute.shingles(t) for d, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    assert got == {d for d, c in brute.union_find(sets, links).items() if c == d}
    assert len(links) == 36 and len(got) == 24


def test_packing_stage_rebuilds_every_copy(spark, documents, odd, sf):
    """The last stage's rows hold the packed ids, and tell copies apart."""
    import zlib
    from collections import defaultdict

    for df in (odd, documents.limit(30).unionByName(documents.limit(30))):
        df = spark.createDataFrame(df.collect(), df.schema)
        out = defaultdict(list)
        for r in corpus_pipeline.pack(spark, df, sf).collect():
            assert zlib.crc32(r.ids) == r.ids_crc32
            out[r.doc_id, r["copy"]].append((r.start, bytes(r.ids)))
        enc = packing.Encoder(tokenizer_path())
        want = sorted((-1 if d is None else d, enc.tok.encode(t or "", add_special_tokens=False).ids + [packing.END_ID])
                      for d, t in pairs(df))
        got = sorted((-1 if d is None else d, np.frombuffer(b"".join(b for _, b in sorted(p)), "<u4").tolist())
                     for (d, _), p in out.items())
        assert got == want


KEPT = """
import ctypes, re
import numpy as np, pyarrow as pa
from bigraph.llm import common, minhash_bayes, quality_nbsvm, suffix_pfp

class Frame:
    def mapInArrow(self, run, schema):
        return sum(b.num_rows for b in run(pa.RecordBatch.from_arrays([pa.array(keys), pa.array(texts)], ["key", "text"]) for _ in range(2)))

def anonymous():
    return int(re.search(r"RssAnon:\\s+(\\d+)", open("/proc/self/status").read())[1]) / 1024

words = np.random.default_rng(1).integers(0, 1 << 40, (4000, 400))
keys, texts = list(range(4000)), [" ".join(map(hex, row.tolist())) for row in words]
steps = [quality_nbsvm._features(18), minhash_bayes._signatures, suffix_pfp._parse_batch(100, 32, 64)]
common.arrow_map(Frame(), lambda b: steps[0](b.slice(0, 10)), "")      # tables that stay
pa.default_memory_pool().release_unused()
ctypes.CDLL("libc.so.6").malloc_trim(0)
before = anonymous()
for step in steps:
    assert common.arrow_map(Frame(), step, "") > 0
    print(round(anonymous() - before))
"""


def test_workers_return_what_steps_have_freed():
    """A Python worker lives on after a task; it must not stay as large as
    the step was (MB left after each one)."""
    done = subprocess.run([sys.executable, "-c", KEPT], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert max(map(int, done.stdout.split())) < 40, done.stdout
