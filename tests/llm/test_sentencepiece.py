import random

import pyarrow.parquet as pq
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as pb

from tavola.llm.sentencepiece_viterbi import MARK, MODEL, Vocabulary, decode, encode, op6_sentencepiece
from tests.llm.conftest import EDGE, TINY


def unigram_library():
    """The library's own Viterbi over the same pieces; scores of mark runs are brought into float range."""
    m = pb.ModelProto()
    m.ParseFromString(open(MODEL, "rb").read())
    m.trainer_spec.model_type = 1
    for p in m.pieces:
        if p.score < -1e8:
            p.score = -31740.0
    return sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())


def test_words_against_library():
    lib = unigram_library()
    text = " ".join(pq.read_table(f"{TINY}/documents.parquet", columns=["text"])["text"].to_pylist()[:60])
    words = sorted({MARK + w for w in text.split()} | {MARK + w for w in ["naïve", "日本語", "a🙂b", "x" * 300, "0x1F;", "();\r"]})
    vocab = Vocabulary.of(open(MODEL, "rb").read())
    assert len(words) > 2000
    got = vocab.encode_sorted(words)
    assert got == lib.encode([w[1:] for w in words])
    rnd = random.Random(1)
    some = rnd.sample(range(len(words)), 200)
    assert [vocab.encode_sorted([words[i]])[0] for i in some] == [got[i] for i in some]


def test_table_round_trip(spark):
    rows = op6_sentencepiece(spark, TINY).collect()
    assert len(rows) == 200 and all(r.round_trip and r.n_ids == len(r.ids) for r in rows)
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    text = dict(zip(*[c.to_pylist() for c in pq.read_table(f"{TINY}/documents.parquet", columns=["doc_id", "text"])]))
    assert all(lib.decode(r.ids) == text[r.doc_id] for r in rows)


def test_edges(spark, make):
    rows = EDGE + [(9, "  two  spaces \n\n next line\ttab "), (9, "\nnewline first"), (10, "é" * 50_000), (11, "퟿🙂 x"), (12, " ")]
    enc = encode(make(rows))
    got = enc.collect()
    assert len(got) == len(rows) and all(r.round_trip for r in got)
    assert [r.ids for r in got if r.doc_id == 1] == [None] and [r.ids for r in got if r.doc_id == 2] == [[]]
    back = sorted((str(r.doc_id), r.text or "") for r in decode(enc).collect())
    assert back == sorted((str(i), t or "") for i, t in rows)
    assert encode(make([])).count() == 0
