import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from indicata.llm import drr_packing as D
from indicata.llm import pii_bootstrap as B
from indicata.llm import queries as Q
from indicata.llm import token_cache as T
from indicata.llm.common import table

SF = "/root/testdata/sf0.001"
BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = ["a   b", "a  b", "x<|endoftext|>y <|startoftext|> z", " lead", "trail \n\n ", "don't I'LL",
       "12 345.67,8", "ΣΑΣ Σ", "é é ́x", "中文 字", "😀😀 ok", "\x1c\x1d a\x85b", "A-B_C!!  \t\tq",
       " wide 　space", "", " ", "\n", "ﬁ ſ İ", "tab\tsep'd 'S's", "Ñandú's Größe, ça—là ǅ İI ß ŉ",
       "a\u0301 A\u030a", "x\xady\xa0z"]


def library(path, texts):
    tok = Tokenizer.from_file(path)
    return [tok.encode(t or "", add_special_tokens=False).ids for t in texts]


# --- operator 1 ---------------------------------------------------------------------------

def test_counter_equals_library():
    texts = ODD + [" ".join(random.Random(i).choices(ODD, k=4)) for i in range(200)]
    counter = T.Counter(BYTE)
    assert counter.pieces
    for _ in range(2):
        assert counter.count(texts) == [len(x) for x in library(BYTE, texts)]
    assert T.Counter(WORD).count(texts) == [len(x) for x in library(WORD, texts)]
    assert T.Counter(public_tokenizers.path("piece_bpe_32k.model")).count(["a b", ""])[1] == 0


def test_counter_with_a_full_memo(monkeypatch):
    monkeypatch.setattr(T, "MEMO_ENTRIES", 3)
    counter = T.Counter(BYTE)
    for _ in range(2):
        assert counter.count(ODD) == [len(x) for x in library(BYTE, ODD)]
    assert len(counter) <= 3


def test_token_query_equals_library(spark):
    rows = table(spark, SF, "documents").select("doc_id", "text").collect()
    ids = library(BYTE, [r.text for r in rows])
    want = {(r.doc_id, len((r.text or "").encode()), len(x), len(x) > 1024)
            for r, x in zip(rows, ids)}
    assert {tuple(r) for r in Q.op1_token_cache(spark, SF).collect()} == want


def test_only_distinct_misses_are_encoded(spark, edge_docs, no_docs, tmp_dir):
    cache = tmp_dir + "/cache"
    first = T.count_tokens(edge_docs.filter("doc_id < 8"), BYTE, cache).collect()
    assert len(first) == 7

    def stored():
        return spark.read.parquet(cache).count()

    assert stored() == edge_docs.filter("doc_id < 8").select(
        F.coalesce("text", F.lit(""))).distinct().count()
    got = T.count_tokens(edge_docs.withColumn("n_bytes", F.lit("clash")), BYTE, cache)
    rows = got.select("doc_id", "text", "n_bytes", "n_tokens", "extra").collect()
    assert len(rows) == 17
    assert [r.n_tokens for r in rows] == [len(x) for x in library(BYTE, [r.text for r in rows])]
    assert stored() == edge_docs.select(F.coalesce("text", F.lit(""))).distinct().count()
    T.count_tokens(edge_docs, WORD, cache)             # another version shares the table
    assert T.count_tokens(edge_docs, BYTE, cache).agg(F.sum("n_tokens")).first()[0] \
        == sum(r.n_tokens for r in rows)
    assert T.count_tokens(no_docs, BYTE, cache).count() == 0


# --- operator 8 ---------------------------------------------------------------------------

def check_pieces(docs, pieces, length=4096):
    """Every id in one piece, sequences gapless, full or a power of two long."""
    ids = {i: np.array([*x, 2], "<u4") for i, x in zip(docs, library(WORD, docs.values()))}
    own, filled = defaultdict(list), defaultdict(list)
    for p in pieces:
        own[p["doc_id"]].append((p["start"], p["length"]))
        filled[p["sequence_id"]].append((p["offset"], p["length"]))
        x = ids[p["doc_id"]]
        assert p["doc_tokens"] == len(x) and p["length"] > 0
        assert p["ids_crc32"] == zlib.crc32(x[p["start"]:p["start"] + p["length"]].tobytes())
    for i, x in ids.items():
        at = 0
        for start, n in sorted(own[i]):
            assert start == at
            at += n
        assert at == len(x)
    assert sorted(filled) == list(range(len(filled)))
    for i, parts in filled.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == length or (at < length and at & (at - 1) == 0)


def test_encoder_equals_library(monkeypatch):
    texts = ODD + [" ".join(random.Random(i).choices(ODD, k=4)) for i in range(200)]
    enc = D.Encoder(WORD)
    assert enc.by_word
    want = [np.array(x, "<u2").tobytes() for x in library(WORD, texts)]
    assert enc.encode(texts) == want and enc.encode(texts) == want
    monkeypatch.setattr(D, "MEMO_ENTRIES", 3)
    assert D.Encoder(WORD).encode(texts) == want


def test_packing_query_is_an_exact_cut(spark):
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    check_pieces(docs, [r.asDict() for r in Q.op8_drr_packing(spark, SF).collect()])


def test_packing_many_blocks_keeps_the_shares(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_TOKENS", 6000)
    monkeypatch.setattr(D, "GROUP", 2)
    rng = random.Random(8)
    rows = [(i, " ".join(f"w{rng.randrange(500)}" for _ in range(rng.randint(10, 60))),
             rng.choices(["hot", "b", None], [0.5, 0.3, 0.2])[0]) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    pieces = [r.asDict() for r in D.pack(docs, WORD, 2, 512).collect()]
    check_pieces({i: t for i, t, _ in rows}, pieces, 512)
    source = {i: s for i, _, s in rows}
    total, served = defaultdict(int), defaultdict(lambda: defaultdict(int))
    for p in pieces:
        total[source[p["doc_id"]]] += p["length"]
        served[p["sequence_id"] // 40][source[p["doc_id"]]] += p["length"]
    whole = sum(total.values())
    assert len(served) > 4
    for group in sorted(served)[:-1]:                     # 40 windows: near the target
        for s, n in total.items():
            assert abs(served[group][s] / (40 * 512) - n / whole) < 0.05


def test_copies_of_one_row_are_packed_by_many_tasks(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "one row " * 200, "s")] * 3000,
                                 "doc_id bigint, text string, source string").repartition(8)
    monkeypatch.setattr(D, "bucketed", lambda rows, *_: rows)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1k")
    try:
        blocks = D._blocks(docs, WORD, 2, "doc_id", "source", "text")
        tasks = {r.block >> 32 for r in blocks.select("block").collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(tasks) > 1


def test_packing_weights_tokens_and_edges(spark, edge_docs, no_docs):
    rows = edge_docs.filter("doc_id IS NOT NULL AND doc_id != 11")
    got = D.pack(rows, WORD, 2, 64, weights={"a": 3, "c": 1}, with_tokens=True).collect()
    check_pieces({r.doc_id: r.text for r in rows.collect()}, [r.asDict() for r in got], 64)
    for r in got:
        assert zlib.crc32(np.array(r.tokens, "<u4").tobytes()) == r.ids_crc32
    assert D.pack(edge_docs, WORD, 2).agg(F.sum("length")).first()[0] == sum(
        len(x) + 1 for x in library(WORD, [r.text for r in edge_docs.collect()]))
    assert D.pack(no_docs, WORD, 2).count() == 0


def test_serve_carries_deficits():
    share = {"a": 0.75, "b": 0.25}
    pieces = list(D.serve([900, 300], ["a", "b"], 0, 1200, 100, share, {"a": 0, "b": 0}))
    by = defaultdict(int)
    for i, _, n, seq, _ in pieces:
        by[seq, i] += n
    assert all(by[s, 0] == 75 and by[s, 1] == 25 for s in range(12))
    late = list(D.serve([100, 100], ["a", "b"], 400, 600, 100, share, {"a": 300, "b": 0}))
    assert sum(n for i, _, n, seq, _ in late if i == 1 and seq == 4) >= 99


# --- operator 4 ---------------------------------------------------------------------------

def plain_spans(text):
    """The contract's patterns, by the plain regular expressions."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((0, *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        luhn = sum(d[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in d[-2::-2])
        if 16 <= len(d) <= 19 and luhn % 10 == 0:
            out.append((2, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((3, *m.span()))
    return out


def test_base_spans_equal_plain_patterns():
    rng = random.Random(4)
    parts = ["a@b.c", "@", ".", "1.2.3.4", "256.1.1.1", "+1 (555) 123-4567", "4111111111111111", "x", "-",
             "4111 1111-1111 1111", " ", "é", "1", "0", "a.b", "@c.d", "+", "((", "12", "\n", "00.01.002.3"]
    for _ in range(20_000):
        text = "".join(rng.choices(parts, k=rng.randint(1, 12)))
        assert B.base_spans(text) == plain_spans(text), text


def test_long_runs_stay_linear():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "@" * 300_000, "+1" + " " * 300_000,
                 "a@" * 150_000, "1 " * 150_000, "a" * 300_000 + "@"):
        B.mentions(text, B.base_spans(text))


def test_pii_query_base_equals_plain_patterns(spark):
    rows = table(spark, SF, "documents").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in Q.op4_pii_bootstrap(spark, SF).collect()}
    assert len(got) == len(rows)
    for r in rows:
        spans = plain_spans(r.text or "")
        line = ",".join(f"{B.KINDS[k]}:{a}:{b}" for k, a, b in spans)
        g = got[r.doc_id]
        assert [g.n_email, g.n_ip, g.n_card, g.n_phone] == [
            sum(k == x for x, _, _ in spans) for k in range(4)]
        assert g.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert set(line.split(",")) - {""} <= set(g.spans.split(","))


def card(rng):
    d = [rng.randrange(10) for _ in range(15)]
    s = sum(sum(divmod(2 * x, 10)) for x in d[-1::-2]) + sum(d[-2::-2])
    return "".join(map(str, d)) + str(-s % 10)


def test_contexts_of_seeds_find_unseen_identifiers(spark):
    rng = random.Random(9)
    rows = [(i, f"noise w{i} pay by card {card(rng)} today please") for i in range(30)]
    bad = card(rng)
    bad = bad[:-1] + str((int(bad[-1]) + 1) % 10)         # fails the check digit
    rows += [(100, f"then pay by card {bad} today again"), (101, f"order number {bad} elsewhere"),
             (102, "pay by card soon today"), (103, "build 20240101123456 of the tool")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: [s.kind for s in r.spans] for r in B.find(docs).collect()}
    assert got[100] == ["card"] and got[0] == ["card"]
    assert got[101] == [] and got[102] == [] and got[103] == []


def test_contexts_of_seeds_find_shapes_that_no_seed_has(spark):
    rows = [(i, f"w{i} please call me at +1 (555) 010-{1000 + i} today or later") for i in range(20)]
    rows += [(20 + i, f"v{i} then write to jane{i}@example.com again") for i in range(20)]
    texts = {100: "x call me at 020-7946-0958 today or later", 101: "x room 020-7946-0958 is free",
             102: "y then write to jane1234@intranet again"}
    docs = spark.createDataFrame(rows + list(texts.items()), "doc_id bigint, text string")
    got = {r.doc_id: [(s.kind, texts[r.doc_id][s.start:s.end]) for s in r.spans]
           for r in B.find(docs).collect() if r.doc_id in texts}
    assert got == {100: [("phone", "020-7946-0958")], 101: [], 102: [("email", "jane1234@intranet")]}


def test_candidates_have_no_digit_length_or_space_gates(spark):
    rows = [(i, f"w{i} please call me at +1 (555) 010-{1000 + i} today or later") for i in range(20)]
    rows += [(20 + i, f"v{i} then write to jane{i}@example.com again") for i in range(20)]
    rows += [(40 + i, f"mail jo{i}@example.org") for i in range(20)]
    name = "j" * 90 + "@intranet"
    texts = {100: ("x call me at 020 7946 0958 today or later", "phone", "020 7946 0958"),
             101: ("y then write to jane@intranet again", "email", "jane@intranet"),
             102: (f"y then write to {name} again", "email", name),
             103: ("y then write to jane @ intranet again", "email", "jane @ intranet"),
             104: ("mail jane@intranet", "email", "jane@intranet"),
             105: ("z call me at 01 23 45 67 89 10 please", "phone", "01 23 45 67 89 10"),
             106: ("x room 020 7946 0958 is free", None, None)}
    docs = spark.createDataFrame(rows + [(i, t) for i, (t, _, _) in texts.items()],
                                 "doc_id bigint, text string")
    got = {r.doc_id: [(s.kind, texts[r.doc_id][0][s.start:s.end]) for s in r.spans]
           for r in B.find(docs).collect() if r.doc_id in texts}
    assert got == {i: [(k, x)] if k else [] for i, (_, k, x) in texts.items()}


def test_mentions_of_runs_equal_plain_enumeration():
    rng = random.Random(6)
    parts = ["a", "b", "12", "x@", "(3)", "##", "a@b.c", "+1 555 010 1000", "c.", "7,"]
    for _ in range(3000):
        text = " ".join(rng.choices(parts, k=rng.randint(1, 12)))
        spans = B.base_spans(text)
        tokens = [m.span() for m in re.finditer(r"\S+", text)]
        words = ["^", *(text[a:b].strip(B.EDGE).lower() or text[a:b] for a, b in tokens), "$"]
        free = [all(y <= a or b <= x for _, x, y in spans) for a, b in tokens]
        bare = [bool(text[a:b].strip(B.EDGE)) for a, b in tokens]
        want = set()
        for i in range(len(tokens)):
            for j in range(i, min(i + B.RUN, len(tokens))):
                raw = text[tokens[i][0]:tokens[j][1]]
                if (all(free[i:j + 1]) and bare[i] and bare[j] and re.search("[0-9@]", raw)
                        and not {words[i], words[j + 2]} & set(words[i + 1:j + 2])):
                    surface = raw.strip(B.EDGE)
                    want.add((surface, f"{words[i]} _ {words[j + 2]} {'@' if '@' in raw else '0'}"))
        got = {(s, p) for _, _, k, s, ps in B.mentions(text, spans) if k is None for p in ps
               if not p.endswith("_") and len(s.split()) <= B.RUN}
        assert got == want, text


def plain_candidates(text):
    """Start, end, surface, patterns, and whether a seed must have the pattern; by enumeration."""
    spans = B.base_spans(text)
    tokens = [m.span() for m in re.finditer(r"\S+", text)]
    raw = [text[a:b] for a, b in tokens]
    words = ["^", "^", *(r.strip(B.EDGE).lower() or r for r in raw), "$"]
    n = len(tokens)
    free = [all(y <= a or b <= x for _, x, y in spans) for a, b in tokens]
    marked = [f and bool(re.search(r"[\d@]", r)) for f, r in zip(free, raw)]
    bridge = [f and not any(c.isalpha() for c in r) for f, r in zip(free, raw)]

    def longest(member):
        every = [(i, j) for i in range(n) for j in range(i, n)
                 if marked[i] and marked[j] and all(member[i:j + 1])]
        return {(i, j) for i, j in every
                if not any((x, y) != (i, j) and x <= i and j <= y for x, y in every)}

    chains = longest([m or b for m, b in zip(marked, bridge)])
    out = []

    def add(i, j, pattern, short):
        surface = text[tokens[i][0]:tokens[j][1]]
        a = tokens[i][0] + len(surface) - len(surface.lstrip(B.EDGE))
        surface = surface.strip(B.EDGE)
        out.append((a, a + len(surface), surface, pattern.format("@" if "@" in surface else "0"), short))

    for i, j in chains | longest(marked):
        add(i, j, f"{words[i]} {words[i + 1]} {{}} _", False)
        if j - i >= B.RUN:
            add(i, j, f"{words[i + 1]} _ {words[j + 3]} {{}}", False)
    for i in range(n):
        for j in range(i, min(i + B.RUN, n)):
            if (all(free[i:j + 1]) and any(marked[i:j + 1]) and raw[i].strip(B.EDGE)
                    and raw[j].strip(B.EDGE)
                    and not {words[i + 1], words[j + 3]} & set(words[i + 2:j + 3])):
                add(i, j, f"{words[i + 1]} _ {words[j + 3]} {{}}", (i, j) not in chains)
    return spans, out


def plain_find(texts, confidence=0.8, support=3, score=0.8):
    """Spans of every text, by the pattern-instance graph in dictionaries."""
    seeds = [[m for m in B.mentions(t, B.base_spans(t)) if m[2]] for t in texts]
    known = {p for ms in seeds for m in ms for p in m[4]}
    found = [[c for c in plain_candidates(t)[1] if not c[4] or c[3] in known] for t in texts]
    links = defaultdict(dict)
    for ms in seeds:
        for _, _, kind, surface, patterns in ms:
            for p in patterns:
                links[p][surface] = max(kind, links[p].get(surface) or "")
    for cs in found:
        for _, _, surface, p, _ in cs:
            links[p].setdefault(surface, None)
    trusted, accepted = {}, {}
    while True:
        for p, at in links.items():
            w, count = defaultdict(float), defaultdict(int)
            for surface, kind in at.items():
                got = (kind, 1.0) if kind else accepted.get(surface, (None, 0.0))
                w[got[0]] += got[1]
                count[got[0]] += 1
            kind = max(w, key=lambda k: (w[k], k or ""))
            if kind and count[kind] >= support and round(w[kind] / len(at), 9) >= confidence:
                trusted.setdefault(p, (kind, round(w[kind] / len(at), 9)))
        votes = defaultdict(lambda: defaultdict(lambda: 1.0))
        for p, (kind, c) in trusted.items():
            for surface, seed in links[p].items():
                if not seed and surface not in accepted:
                    votes[surface][kind] *= 1 - min(c, 0.999)
        new = {s: max(((k, 1 - x) for k, x in v.items()), key=lambda kx: (kx[1], kx[0]))
               for s, v in votes.items()}
        new = {s: v for s, v in new.items() if v[1] >= score}
        if not new:
            break
        accepted.update(new)
    out = []
    for text, cs in zip(texts, found):
        own = {(B.KINDS[k], a, b) for k, a, b in B.base_spans(text)}
        more = {(trusted[p][0], a, b) for a, b, s, p, _ in cs
                if p in trusted and accepted.get(s, (None,))[0] == trusted[p][0]}
        out.append(own | {(k, a, b) for k, a, b in more if not any(
            (x, y) != (a, b) and k == z and x <= a and b <= y for z, x, y in more)})
    return out


def test_spans_equal_the_plain_graph(spark):
    rng = random.Random(21)
    words = ["call", "me", "at", "mail", "to", "now", "room", "-", "|", "see", "##"]
    values = [lambda: f"+1 555 010 {rng.randint(1000, 1400)}", lambda: f"jo{rng.randint(0, 400)}@a.org",
              lambda: f"020 7946 {rng.randint(10, 15)}", lambda: f"jo{rng.randint(0, 9)}@intranet",
              lambda: f"020 - 7946 - 09 - {rng.randint(10, 15)}", lambda: str(rng.randint(1, 40)),
              lambda: f"ring {rng.randint(1, 9)} then", lambda: f"10.0.{rng.randint(0, 9)}.{rng.randint(0, 30)}"]
    texts = []
    for _ in range(400):
        parts = []
        for _ in range(rng.randint(1, 4)):
            at = rng.randrange(4)
            lead = [["call", "me", "at"], ["mail", "to"], ["host", "is"], rng.choices(words, k=2)][at]
            pick = values[rng.choice([[0, 0, 0, 0, 0, 2, 4], [1, 1, 1, 1, 1, 3], [7, 7, 7, 5],
                                      range(8)][at])]()
            parts += [*lead, pick, rng.choice(["now", "please", "today"])]
        texts.append(" ".join(parts))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: {tuple(s) for s in r.spans} for r in B.find(docs).collect()}
    want = plain_find(texts)
    assert [got[i] for i in range(len(texts))] == want
    base = sum(len(B.base_spans(t)) for t in texts)
    assert sum(map(len, want)) > base + 20


def test_candidates_equal_plain_enumeration_and_the_gate_drops_short_runs_only():
    rng = random.Random(8)
    parts = ["a", "b", "12", "x@", "(3)", "##", "-", "a@b.c", "+1 555 010 1000", "c.", "7,", "½"]
    shut = B.Gate(bytes(B.BITS // 8), bytes(B.BITS // 8))
    for _ in range(2000):
        text = " ".join(rng.choices(parts, k=rng.randint(1, 14)))
        spans, want = plain_candidates(text)
        got = {(a, b, s, p, short) for a, b, k, s, ps, short in B._mentions(text, spans, None)
               if k is None for p in ps}
        assert got == set(want), text
        left = {(a, b, s, p, short) for a, b, k, s, ps, short in B._mentions(text, spans, shut)
                if k is None for p in ps}
        assert left == {c for c in want if not c[4]}, text


def test_chains_of_any_length_are_found(spark):
    rows = [(i, f"w{i} please call me at +1 (555) 010-{1000 + i} today or later") for i in range(20)]
    digits = " - ".join(str(10 + i) for i in range(40))
    texts = {100: ("x call me at 020 - 7946 - 09 - 58 today", "020 - 7946 - 09 - 58"),
             101: (f"x call me at {digits} today", digits), 102: ("x room 020 - 7946 - 09 - 58 is free", None)}
    docs = spark.createDataFrame(rows + [(i, t) for i, (t, _) in texts.items()],
                                 "doc_id bigint, text string")
    got = {r.doc_id: [(s.kind, texts[r.doc_id][0][s.start:s.end]) for s in r.spans]
           for r in B.find(docs).collect() if r.doc_id in texts}
    assert got == {i: [("phone", x)] if x else [] for i, (_, x) in texts.items()}


def test_long_texts_of_numbers_need_little():
    shut = B.Gate(bytes(B.BITS // 8), bytes(B.BITS // 8))
    text = " ".join(str(i) for i in range(150_000))
    got = B._mentions(text, B.base_spans(text), shut)
    assert sum(m[2] is None for m in got) <= 200
    words = "a 1 " * 200_000
    assert len(B._mentions(words, [], shut)) <= 400_000


def test_pii_edges(edge_docs, no_docs):
    rows = B.find(edge_docs).collect()
    assert len(rows) == 17 and all(len(r.base) <= len(r.spans) for r in rows)
    assert B.find(no_docs).count() == 0
