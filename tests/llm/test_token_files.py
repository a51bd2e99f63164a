import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tallyloom.llm import token_files as T

public_tokenizers = pytest.importorskip("public_tokenizers")
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def expected(rows):
    from tokenizers import Tokenizer

    tok, start, out = Tokenizer.from_file(VOCABULARY), 0, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_against_whole_text_encoding(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in T.op5_token_files(spark, sf_dir).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == expected(rows)


ODD = [(3, None), (1, ""), (7, " \t\n"), (5, "don't STOP 12,5 €  naïve é x y"), (6, "a<|endoftext|>b <|startoftext|>"), (9, "x" * 100_000), (8, "wörter " * 30_000), (4, " ́ ̸"), (2, "ΣΑΣ İstanbul ǅ")]


@pytest.mark.parametrize("encoding", ["delta", "dictionary"])
@pytest.mark.parametrize("whole", [False, True])
def test_odd_texts_and_selective_reads(spark, tmp_path, encoding, whole):
    df = spark.createDataFrame([(*r, "z", 0) for r in ODD], "doc_id bigint, text string, ids string, part int")
    path = str(tmp_path / "tokens")
    T.write_token_files(df, path, VOCABULARY, whole=whole, encoding=encoding)
    want = expected(ODD)
    assert [(r.doc_id, r.start, r.n_tokens) for r in T.read_metadata(spark, path).orderBy("doc_id").collect()] == [x[:3] for x in want]
    (one,) = T.read_tokens(spark, path, [5]).collect()
    assert zlib.crc32(np.array(one.ids, "<u4").tobytes()) == next(x[3] for x in want if x[0] == 5)
    assert "PushedFilters: [In(doc_id" in T.read_tokens(spark, path, [5, 6])._jdf.queryExecution().toString() or "doc_id" in T.read_tokens(spark, path, [5, 6])._jdf.queryExecution().toString()
    for file in (tmp_path / "tokens").glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        if meta.num_rows:
            column = meta.row_group(0).column(meta.num_columns - 1)
            assert column.has_offset_index and meta.row_group(0).column(0).has_column_index
            assert ("DELTA_BINARY_PACKED" if encoding == "delta" else "DICTIONARY") in str(column.encodings)


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "none")
    T.write_token_files(spark.createDataFrame([], "doc_id bigint, text string"), path, VOCABULARY)
    assert T.read_metadata(spark, path).count() == 0


def test_pieces_agree_with_whole_texts():
    import random

    rng = random.Random(8)
    parts = ["A", "b", "Z9", "12", "é", "É", "×", "÷", "ß", "ÿ", "µ", "ª", "'s", "don't", "<|", "<|endoftext|>", "<|ENDOFTEXT|>", "|", "<", "|>", "...", "-", "_", "\u0301", "I\u0307", "Σ", "ǅ", "漢字", "🙂", "\x00", "\x1c", "\u00a0", "\u0085", "\u2028", " ", "\t", "\n", "  ", "Ã", "Â", "K", "ﬁ", "½", "²", "٣", "'", "''LL"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(0, 14))) for _ in range(4000)]
    a, b = T.WordEncoder(VOCABULARY).encode(pa.array(texts)), T.WordEncoder(VOCABULARY, whole=True).encode(pa.array(texts))
    assert all(x.tolist() == y.tolist() for x, y in zip(a, b, strict=True))


def test_cache_bound_does_not_change_ids(monkeypatch):
    monkeypatch.setattr(T, "CACHED_WORDS", 3)
    encoder, whole = T.WordEncoder(VOCABULARY), T.WordEncoder(VOCABULARY, whole=True)
    for texts in (["a b c d", "e f g"], ["c d zz", None, "a q"], ["g zz a b"]):
        for x, y in zip(encoder.encode(pa.array(texts, pa.string())), whole.encode(pa.array(texts, pa.string())), strict=True):
            assert x.tolist() == y.tolist()
