import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from delaynet.llm.queries import QUERIES
from delaynet.llm.token_counts import count_tokens, frequent_table
from delaynet.llm.vocabularies import marked_words

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)


@settings(deadline=None, max_examples=400)
@given(st.lists(st.sampled_from(list(" \n\tab1é中😀▁\x1c 　​") + ["<s>", "</s>", "<0x0A>", "  "]), max_size=30).map("".join))
def test_units_hold_the_tokens_of_the_text(text):
    mark = LIBRARY.piece_to_id("▁")
    units = [LIBRARY.encode(unit) if unit else [mark] for unit in marked_words(text)]
    assert [i for ids in units for i in ids] == LIBRARY.encode(text)


def expected(rows, limit):
    out = []
    for doc_id, text in rows:
        n = len(LIBRARY.encode(text or ""))
        out.append((doc_id, len((text or "").encode()), n, n > limit))
    return sorted(out, key=str)


def test_awkward_rows(awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    for sample_rows, units in ((1000, 65536), (1, 3), (1000, 0)):  # the frequent table changes no count
        found = count_tokens(awkward, MODEL, limit=6, sample_rows=sample_rows, table_units=units)
        assert sorted((tuple(r) for r in found.select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()), key=str) == expected(rows, 6)


def test_no_documents(no_documents):
    assert frequent_table(no_documents, MODEL)[0] == ""
    assert count_tokens(no_documents, MODEL).collect() == []


def test_query_counts_all_documents(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = QUERIES["op4_token_counts"](spark, sf_dir).select("doc_id", "n_bytes", "n_tokens", "over_limit")
    assert sorted((tuple(r) for r in found.collect()), key=str) == expected(rows, 4096)
