import struct
import zlib

import pyarrow.parquet as pq
from tokenizers import Tokenizer

from tessera.llm import tokens as T
from tessera.llm.common import shared_path
from tessera.llm.queries import QUERIES, vocabulary

SF = "/root/testdata/sf0.01"


def brute(docs):
    tok, at, out = Tokenizer.from_file(vocabulary()), 0, []
    for i, t in sorted(docs):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((i, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    return out


def test_query_against_the_tokenizer(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(tuple(r) for r in QUERIES["op6_tokens"](spark, SF).collect()) == brute(docs)


def test_odd_texts_and_file_layout(spark, docs_of, monkeypatch):
    monkeypatch.setattr(T, "MEMO_WORDS", 50)
    odd = ["don't, we'll... I'M", "a<|endoftext|>b. <|ENDOFTEXT|>. x", "é.́, é. …. …a.", "",
           None, " \t  a\u0085b​.", "3.14, 42! 2². 你好。.,", "ΣΣ. AΣ", "#$%&;: .", "\x1c a\x1db.",
           "w" * 30000 + " " + "word. " * 40000, "İstanbul. ﬁne, 한국."]
    docs = docs_of(dict(enumerate(odd))).withColumnRenamed("lang", "ids")
    path = T.write_tokens(docs, shared_path(spark, "t"), tokenizer=vocabulary(), keep=("source",))
    want = brute(enumerate(odd))
    assert sorted(tuple(r) for r in T.token_digest(spark, path).collect()) == want
    index = T.token_index(spark, path)
    assert sorted((r.doc_id, r.start, r.n_tokens) for r in index.collect()) == [w[:3] for w in want]
    assert "ids" not in index._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    import glob
    meta = [pq.ParquetFile(f).metadata for f in glob.glob(f"{path.removeprefix('file:')}/*.parquet")]
    cols = [m.row_group(g).column(m.num_columns - 1) for m in meta for g in range(m.num_row_groups)]
    assert all(c.has_column_index and c.has_offset_index for c in cols)
    empty = T.write_tokens(docs.limit(0), shared_path(spark, "t"), tokenizer=vocabulary())
    assert T.token_digest(spark, empty).collect() == []
