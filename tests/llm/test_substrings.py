from __future__ import annotations

import random
import re

from dialogeval.llm import substrings as sub
from dialogeval.llm.queries import QUERIES


def units(text):
    """(words, low, high, first word, word behind) of the lines, sentences and runs of short sentences that count."""
    at = before = 0
    for line in re.findall(r"[^\n]*\n|[^\n]+\Z", text or ""):
        spans = [(m.start(), m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]+", line)]
        words = [re.sub("[A-Z]", lambda m: m[0].lower(), line[a:b]) for a, b in spans]
        if len(words) >= sub.LINE_WORDS:
            yield tuple(words), at, at + len(line), before, before + len(words)
        first = [i for i in range(len(words)) if i == 0 or words[i - 1][-1] in ".!?"]
        for i in first:
            j = next((j for j in [*first, len(words)] if j - i >= sub.SENTENCE_WORDS), None)
            if j and (i, j) != (0, len(words)):
                end = at + (spans[j][0] if j < len(words) else spans[-1][1])
                yield tuple(words[i:j]), at + spans[i][0], end, before + i, before + j
        at, before = at + len(line), before + len(words)


def brute(texts):
    first = {}
    for i, text in sorted(texts, key=lambda t: (t[0] is None, t[0] or 0)):
        for key, _, _, begin, stop in sorted(units(text), key=lambda u: u[3]):
            first.setdefault(key, (i, begin, stop))
    out = []
    for i, text in texts:
        gone = set()
        for key, low, high, begin, _ in units(text):
            if first[key][0] != i or begin >= first[key][2]:
                gone |= set(range(low, high))
        out.append((str(i), "".join(c for k, c in enumerate(text or "") if k not in gone)))
    return sorted(out)


def rows_of(df):
    return sorted((str(r["doc_id"]), r["text"]) for r in df.collect())


def test_tables_against_brute_force(spark, sf_dir):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = QUERIES["op3_substring_dedup"](spark, sf_dir)
    assert rows_of(got) == brute(texts)
    whole = dict(texts)
    for r in got.collect():
        text = whole[r["doc_id"]]
        kept, removed = ([[int(x) for x in s.split(":")] for s in r[c].split(",") if s] for c in ("kept", "removed"))
        assert "".join(text[a:b] for a, b in kept) == r["text"] and len(removed) == r["n_removed"]
        # Both kinds of spans together are the whole text, without gap or overlap.
        assert [0, *(b for _, b in sorted(kept + removed))] == [*(a for a, _ in sorted(kept + removed)), len(text)]


def test_lines_and_sentences(docs_of):
    rng = random.Random(4)
    lines = ["The same line here.", "the  SAME\tline here.", "ü ß é one", "Two.", "", " ",
             "A long sentence of more than ten words stands right here. And another one of more than ten words follows it now!"]
    texts = [(i, "\n".join(rng.choice(lines) + rng.choice(("", " x y z")) for _ in range(rng.randrange(6))), "s") for i in range(30)]
    texts += [(100, None, "s"), (101, "", "s"), (102, "\n\n\n", "s")]
    assert rows_of(sub.dedup_substrings(docs_of(*texts))) == brute([t[:2] for t in texts])


def test_short_sentences_and_lines_in_paragraphs(docs_of):
    rng = random.Random(3)
    own = lambda n: " ".join(f"q{rng.randrange(10**9)}" for _ in range(n))
    shorts = " ".join(f"{own(3)}." for _ in range(17))
    alone = own(14) + "."
    docs = [(1, f"{own(30)}. {shorts} {own(20)}.", "s"), (2, f"{own(25)}. {shorts} {own(4)}. {own(20)}.", "s"),
            (3, f"{own(9)}\n{alone}\n{own(9)}", "s"), (4, f"{own(12)}. {alone} {own(12)}.", "s")]
    got = {r["doc_id"]: r["text"] for r in sub.dedup_substrings(docs_of(*docs)).collect()}
    assert got[1] == docs[0][1] and got[3] == docs[2][1]
    assert shorts[:-20] not in got[2] and len(got[2].split()) == 25 + 24
    assert alone not in got[4] and len(got[4].split()) == 24
    # Copies of a unit that overlap the first one stay with it.
    laugh = "ha. " * 30 + "end."
    assert rows_of(sub.dedup_substrings(docs_of((1, laugh, "s")))) == brute([(1, laugh)])


def test_no_long_passage_stays_twice(docs_of):
    """Passages of over 50 words that stand between sentences of their own, wherever their sentences end."""
    rng = random.Random(9)
    sentence = lambda: " ".join(f"q{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 16))) + rng.choice(".!?")
    passages = [[sentence() for _ in range(12)] for _ in range(6)]
    passages = [p for p in passages if len(" ".join(p).split()) > 50]
    docs = []
    for i in range(40):
        parts = [sentence() for _ in range(rng.randrange(1, 6))]
        for p in rng.sample(passages, rng.randrange(3)):
            parts += [*p, *(sentence() for _ in range(rng.randrange(1, 4)))]
        docs.append((i, rng.choice(" \n").join(parts), "s"))
    left = {r["doc_id"]: r["text"].split() for r in sub.dedup_substrings(docs_of(*docs)).collect()}
    assert sum(map(len, left.values())) < sum(len(t.split()) for _, t, _ in docs)
    seen = {}
    for i, words in left.items():
        for k in range(len(words) - 49):
            assert seen.setdefault(tuple(words[k : k + 50]), i) == i


def test_edges(docs_of):
    assert sub.dedup_substrings(docs_of()).count() == 0
    same = "one line of words"
    got = rows_of(sub.dedup_substrings(docs_of((4, same, "s"), (4, same, "s"), (9, same, "s"), (None, same, "s"), (None, "only here so far", "s"))))
    assert got == [("4", same), ("4", same), ("9", ""), ("None", ""), ("None", "only here so far")]
