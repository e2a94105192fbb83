"""The pipeline's stages against plain Python, each on what its predecessor kept."""

import hashlib
import random

import numpy as np

import corpus_pipeline
from chunkloom.llm.line_dedup import EDITS, MIN_CHARS
from chunkloom.llm.queries import tokenizer_file

from .test_joins import components_of, shingle_set
from .test_line_dedup import brute


def corpus(tmp_path, spark):
    rnd = random.Random(21)
    vocabulary = ["".join(rnd.choice("aeiorstn") for _ in range(rnd.randint(3, 8))) for _ in range(500)]
    line = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    item, shared = line(40), line(12)
    rows = [(k, "\n".join(line(rnd.randint(3, 30)) for _ in range(4))) for k in range(24)]
    rows += [(30 + k, f"{shared}\n{line(40)}") for k in range(4)]
    rows += [(40, f"{line(20)} {item} {line(20)}"), (41, f"{line(9)} {item.upper()}.")]
    near = line(120).split()
    for k in range(4):
        near[k] = f"other{k}"
        rows.append((50 + k, " ".join(near)))
    rows += [(60 + k, f"{line(20)} idiot moron scum {line(3)}") for k in range(6)]
    rows += [(70, None), (71, ""), (72, rows[3][1])]
    docs = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    labels = [(i, 1, int(60 <= i < 66)) for i, _ in rows if i < 66]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return dict(rows)


def test_stages(spark, tmp_path):
    import sentencepiece

    want = corpus(tmp_path, spark)
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns = docs.columns
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / f"out{k}"))
        docs = spark.read.parquet(str(tmp_path / f"out{k}"))
        if k == 0:
            want = {i: t for i, t in want.items() if not 60 <= i < 66}
        elif k == 1:
            after = brute(list(want.items()), EDITS, MIN_CHARS)
            want = {i: t for i, t in after.items() if t == want[i] or t.strip()}
        elif k == 2:
            sets = {i: shingle_set(t) for i, t in want.items()}
            groups = components_of(list(want), lambda a, b: sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]))
            want = {i: t for i, t in want.items() if groups[i] == i}
            assert {50, 51} & set(want) == {50}
        elif k == 3:
            want = {i: t for i, t in want.items() if i not in (40, 41)}
        if k < 4:
            assert docs.columns == columns, name
            assert {r.doc_id: r.text for r in docs.collect()} == want, name
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file())
    digests = {i: hashlib.sha256(np.array(sp.encode(t or "", add_bos=True, add_eos=True), "<u4").tobytes()).hexdigest() for i, t in want.items()}
    assert {r.doc_id: r.ids_sha256 for r in docs.collect()} == digests
