"""Edit-aware counts on Spark: a table of edits against counting every edited
text anew."""

import random

import public_tokenizers
from tokenizers import Tokenizer

from legwise.llm import token_counts

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def test_a_table_of_edits_equals_counting_anew(spark):
    library = Tokenizer.from_file(BYTE_BPE)
    rng = random.Random(4)
    texts = {i: "".join(rng.choice("ab é'st 12\n.日") for _ in range(rng.choice([0, 3, 50, 900]))) for i in range(40)}
    texts[40] = "long words and numbers 123 " * 20_000
    rows = [(i, t, "clash") for i, t in texts.items()] + [(41, None, None), (42, "", "")]
    edits, want = [], {i: t or "" for i, t, _ in rows}
    for i in list(want):
        for k in range(rng.choice([0, 1, 4])):
            t = want[i]
            at, gone, new = rng.randrange(len(t) + 1), rng.randrange(0, 9), rng.choice(["", "x", " new words", "'s", "日本"])
            edits.append((i, k, at, gone, new))
            want[i] = t[:at] + new + t[at + gone:]
    edits.append((999, 0, 0, 0, "of no document"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_before string").select("doc_id", "text")
    table = spark.createDataFrame(edits, "doc_id long, seq int, start int, removed int, inserted string").repartition(5)
    counted = token_counts.count(docs, BYTE_BPE)
    got = {r.doc_id: r for r in token_counts.apply_edits(counted, table, BYTE_BPE).collect()}
    assert set(got) == set(want)

    def n(text):
        return len(library.encode(text, add_special_tokens=False).ids)
    for i, text in want.items():
        assert got[i].text == text and got[i].n_tokens == n(text)
        assert got[i].n_before == n(texts.get(i) or "")
    assert got[40].n_encoded_chars < 5_000  # of 540,000 characters
    assert token_counts.apply_edits(counted, table.limit(0), BYTE_BPE).where("n_tokens <> n_before").count() == 0
    assert token_counts.count(docs.limit(0), BYTE_BPE).count() == 0
