"""Operators on documents against brute-force versions, on the small tables
and on odd rows (nulls, blanks, long texts, copies, repeated rows, clashing
column names, empty tables)."""

import hashlib
import itertools
import random
import re
import string
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import BODY, ODD, sf001, small, words_of
from pyspark.sql import functions as F

from kpipulse.llm import decontaminate, jaccard, lines, packing, pii, quality, substrings, tokens, toxicity
from kpipulse.llm import words as W


def by_rows(rows, *columns):
    return Counter(tuple(r[c] for c in columns) for r in rows)


# --- words -----------------------------------------------------------------


@given(st.lists(st.one_of(st.none(), st.text(alphabet="abé \U0001f600 \n\x0b\x0c\r\t\x1c\x85", max_size=20)), max_size=8))
@settings(max_examples=150, deadline=None)
def test_words_match_python(texts):
    arr = W.as_binary(pa.array(texts, pa.string()))
    got = W.split_words(arr)
    vocab = got.vocab.to_pylist()
    want = [(t or "").encode().split() for t in texts]
    assert [[vocab[c] for c in got.codes[a:b]] for a, b in zip(got.starts[:-1], got.starts[1:])] == want
    (h1, h2), starts = W.hash_words(arr)
    assert starts.tolist() == got.starts.tolist()
    flat = [w for ws in want for w in ws]
    assert len(set(zip(flat, h1.tolist(), h2.tolist()))) == len(set(flat)) == len(set(h1.tolist()))


def test_window_hashes_depend_on_the_window_only():
    h = np.random.default_rng(1).integers(0, 1 << 63, 200, dtype=np.uint64)
    for size in (1, 5, 8, 13, 20):
        every = W.window_hashes(h, size)
        assert len(every) == 201 - size
        assert all(W.window_hashes(h[i : i + size], size)[0] == every[i] for i in (0, 7, 99, 200 - size))
    assert len(W.window_hashes(h[:3], 5)) == 0


# --- packing ---------------------------------------------------------------


def _tokenizer():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _check_packing(rows, texts, max_len):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(_tokenizer())
    want = Counter()
    for i, t in texts:
        ids = np.array([*tk.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        for a in range(0, len(ids), max_len):
            part = ids[a : a + max_len]
            want[(i, a, len(part), zlib.crc32(part.tobytes()), len(ids))] += 1
    assert by_rows(rows, "doc_id", "start", "length", "ids_crc32", "doc_tokens") == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= max_len
    return len(sequences)


def test_packing_small(spark):
    texts = small(spark)
    rows = packing.pack(sf001(spark, "documents"), _tokenizer()).collect()
    n = _check_packing(rows, texts, 4096)
    assert sum(r["length"] for r in rows) > 0.97 * 4096 * (n - 1)


def test_packing_odd(spark, odd, none):
    rows = packing.pack(odd, _tokenizer(), max_len=64, keep_ids=True).collect()
    _check_packing(rows, ODD, 64)
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in rows)
    assert packing.pack(none, _tokenizer()).count() == 0


def _ids_by_word(coder, texts):
    ids, starts = coder.encode(W.as_binary(pa.array(texts)))
    return [ids[a:b].tolist() for a, b in zip(starts, starts[1:])]


def test_packing_word_cache(monkeypatch):
    """Ids of cached words, short and long, with control bytes, and after the
    cache was emptied, are those of the library."""
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "CACHED_WORDS", 300)
    tk, coder = Tokenizer.from_file(_tokenizer()), packing.WordEncoder(_tokenizer())
    rng = np.random.default_rng(3)
    vocab = ["a", "a\0", "a\0\0", "\0", "\0a", "é" * 7, "é" * 8, "x" * 15, "x" * 16, "x" * 15 + "\0", "end.", "(end)", "\U0001f600" * 4, "ABC" * 40]
    vocab += ["".join(rng.choice(list("abcé,\0"), rng.integers(1, 30))) for _ in range(400)]
    for _ in range(12):
        texts = [" ".join(rng.choice(vocab, 60)) for _ in range(4)] + ["", vocab[rng.integers(len(vocab))]]
        assert _ids_by_word(coder, texts) == [tk.encode(t, add_special_tokens=False).ids for t in texts]


def test_packing_letters_and_marks():
    """Ids of words with letters that change, join or split on the way are
    those of the library."""
    from tokenizers import Tokenizer

    tk, coder = Tokenizer.from_file(_tokenizer()), packing.WordEncoder(_tokenizer())
    rng = np.random.default_rng(4)
    chars = list("aBz'.,&|<>=1") + ["'s", "\u0301", "\u0307", "\u0338", "É", "İ", "ı", "ß", "Σ", "σ", "ς", "Ġ", "Ä", "ł", "가", "ᄀ", "ᅡ", "中", "ﬁ", "Ω", "\u2126", "\u00a0", "<|endoftext|>"]
    vocab = ["".join(rng.choice(chars, rng.integers(1, 9))) for _ in range(6000)] + [c * n for c in chars for n in (1, 2, 20)]
    texts = [" ".join(vocab[i : i + 50]) for i in range(0, len(vocab), 50)]
    assert _ids_by_word(coder, texts) == [tk.encode(t, add_special_tokens=False).ids for t in texts]


def test_packing_words_of_one_hash(monkeypatch):
    """Words whose hashes agree keep their own ids, in one batch and later."""
    from tokenizers import Tokenizer

    monkeypatch.setattr(W, "mix", lambda a, b: (a ^ b) % np.uint64(5))
    tk, coder = Tokenizer.from_file(_tokenizer()), packing.WordEncoder(_tokenizer())
    rng = np.random.default_rng(5)
    vocab = ["".join(rng.choice(list("abcdé."), rng.integers(1, 20))) for _ in range(200)]
    for n in (1, 2, 3, 60, 60, 60):
        texts = [" ".join(rng.choice(vocab, n)) for _ in range(4)]
        assert _ids_by_word(coder, texts) == [tk.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(coder.hashes) == 5


def test_packing_learns_many_words_at_once():
    """New words of letters, with marks at their end or not, go through the
    tokenizer many in one text."""
    coder, given = packing.WordEncoder(_tokenizer()), []

    class Counted:
        def __init__(self, tokenizer):
            self.tokenizer = tokenizer

        def encode_batch_fast(self, texts, **how):
            given.extend(texts)
            return self.tokenizer.encode_batch_fast(texts, **how)

        def encode(self, text, **how):
            given.append(text)
            return self.tokenizer.encode(text, **how)

    coder.letters, coder.tokenizer = Counted(coder.letters), Counted(coder.tokenizer)
    words = [f"{''.join(x)}{end}" for x in itertools.product("abcdefghij", repeat=3) for end in ("", ".", "é,", "&&&")]
    coder.encode(W.as_binary(pa.array([" ".join(words)])))
    assert len(given) <= len(words) / 100


def test_packing_word_cache_is_small():
    coder = packing.WordEncoder(_tokenizer())
    words = [f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}x{chr(97 + i // 17576)}" for i in range(200_000)]
    tracemalloc.start()
    try:
        for i in range(0, len(words), 20_000):
            coder.encode(W.as_binary(pa.array([" ".join(words[i : i + 20_000])])))
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert held < 60 * len(words)


@given(st.dictionaries(st.integers(1, 64), st.sampled_from([1, 2, 7, 5000]), max_size=20))
@settings(max_examples=100, deadline=None)
def test_patterns_hold_every_piece(histogram):
    patterns = packing.plan_patterns(histogram, 64)
    held = Counter()
    for p in patterns:
        assert p.room == 64 - sum(a * b for a, b in p.slots) >= 0 and p.packs > 0
        for length, each in p.slots:
            held[length] += each * p.packs
    assert held == Counter(histogram)


# --- personal data ---------------------------------------------------------


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _base(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and _luhn(digits):
            out.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end(), "phone"))
    return sorted(out)


TRICKY = [
    "a@b.c%d@e.f x.y@z.w. @no.com me@host, 1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.0255 9999999999999999999999.1.1.1",
    "é\U0001f600 +1 (743) 555-3824 +49-30-1234567890 ++12 34567890 +1..........2 4111 1111 1111 1111 4111-1111-1111-1112",
    "4111111111111111 41111111111111111111 0 1 2 3 4 5 6 7 8 9 0 1 2 3 79927398713000",
    "9" * 6_000 + " " + "a" * 6_000 + "@" + " a.b@c.d",
    "+1" + " " * 5000 + "2",
    "٣٤.1.1.1.1 1.1.1.1٣",
]


def test_pii_base(spark, odd):
    texts = [t for _, t in ODD] + TRICKY + [t for _, t in small(spark)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: [tuple(s) for s in r["base"]] for r in pii.extract(rows).collect()}
    for i, t in enumerate(texts):
        assert got[i] == _base(t or ""), t[:80]
    kept = pii.extract(odd).collect()
    assert Counter(r["doc_id"] for r in kept) == Counter(i for i, _ in ODD)


def test_pii_empty(none):
    assert pii.extract(none).count() == 0


_S, _ID = r"[^ \t\n\x0b\f\r]", r"[^ \t\n\x0b\f\r0-9@]*[0-9@][^ \t\n\x0b\f\r]*"


def _bare(word):
    return word.strip(string.punctuation) or word


def _candidates(text):
    """Candidates of a text: run, whole, start, end, token, contexts."""
    out = []
    for m in re.finditer(rf"(?<!{_S}){_ID}(?: {_ID})*", text):
        ahead = re.findall(rf"{_S}+", text[max(0, m.start() - 80) : m.start()].lower())
        behind = re.findall(rf"{_S}+", text[m.end() : m.end() + 80].lower())
        left = _bare(ahead[-1]) if ahead else ""
        two = _bare(ahead[-2]) + " " + left if len(ahead) > 1 else ""
        right = _bare(behind[0]) if behind else ""
        tokens = list(re.finditer(rf"{_S}+", m.group()))
        pieces = [(True, m.start(), m.group(), left, two, right)]
        if len(tokens) > 1:
            for k, t in enumerate(tokens):
                first, last = k == 0, k == len(tokens) - 1
                pieces.append((False, m.start() + t.start(), t.group(), left * first, two * first, right * last))
        for whole, start, hit, *words in pieces:
            lead = re.match(r"[!-'*,-/:-?\[-`{-~]*", hit).end()
            core = hit[lead:].rstrip(string.punctuation)
            start += lead
            if core.startswith("(") and ")" not in core:
                core, start = core[1:], start + 1
            if core:
                out.append((m.start(), whole, start, start + len(core), core, words))
    return out


def _shape(token):
    if re.match(r"^(?=.*[0-9])(?=.*[A-Fa-f])(?:[0-9a-f]{32,}|[0-9A-F]{32,})$", token):
        return f"hex {len(token)}"
    digits = len(re.sub("[^0-9]", "", token))
    return regex.sub(r"\p{L}+", "a", re.sub("[0-9]", "9", token)) if digits >= 6 else ""


def _discover(texts, rounds=2, min_confidence=0.8, min_belief=0.8):
    """Added spans of each text (start, rank, end), by the definition."""
    rows, links = [], defaultdict(lambda: -1)
    for d, text in enumerate(texts):
        base = _base(text)
        for run, whole, start, end, token, words in _candidates(text):
            own = [rank for s, rank, e, _ in base if (s, e) == (start, end)]
            if not own and any(s < end and e > start for s, _, e, _ in base):
                continue
            key = 4 if _shape(token).startswith("hex") else -1
            seed = min(own) if own else key
            marks = [f"{n} {c}" for n, c in zip(("L", "LL", "R", "S"), (*words, _shape(token))) if c]
            rows.append((d, run, whole, start, end, token, seed, marks))
            for p in marks:
                links[p, token] = max(links[p, token], seed)
    seeds = defaultdict(lambda: -1)
    for (_, token), seed in links.items():
        seeds[token] = max(seeds[token], seed)
    seeds = {t: (k, 1.0) for t, k in seeds.items() if k >= 0}
    believed, patterns = dict(seeds), {}
    of = defaultdict(list)
    for p, token in links:
        of[p].append(token)
    for _ in range(rounds):
        patterns = {}
        for p, tokens in of.items():
            sure = [believed[t] for t in tokens if t in believed]
            for kind in {k for k, _ in sure}:
                mass = sum(b for k, b in sure if k == kind)
                support = sum(k == kind for k, _ in sure)
                over = sum(b for _, b in sure) if p.startswith("S ") else len(tokens)
                if support >= (3 if p.startswith("S ") else 5) and mass / over >= min_confidence:
                    patterns[p, kind] = mass / over
        votes = defaultdict(lambda: 1.0)
        for p, token in links:
            for kind in range(5):
                if (p, kind) in patterns:
                    votes[token, kind] *= max(1e-9, 1 - patterns[p, kind])
        grown = {}
        for (token, kind), doubt in votes.items():
            if token not in seeds and (token not in grown or (1 - doubt, -kind) > (grown[token][1], -grown[token][0])):
                grown[token] = (kind, 1 - doubt)
        believed = seeds | grown
    added = [set() for _ in texts]
    runs = [set() for _ in texts]
    for d, run, whole, start, end, token, seed, marks in rows:
        kind, belief = believed.get(token, (None, 0.0))
        digits = len(re.sub("[^0-9]", "", token))
        told = any((p, kind) in patterns and (p.startswith("S ") or digits >= 4) for p in marks)
        if seed in (-1, 4) and belief >= min_belief and told:
            added[d].add((run, whole, start, kind, end))
            runs[d] |= {run} if whole else set()
    return [sorted((s, k, e) for run, whole, s, k, e in found if whole or run not in r) for found, r in zip(added, runs)]


def _added(spark, rows):
    out = {r["doc_id"]: r for r in pii.extract(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    got = [sorted(tuple(x)[:3] for x in out[i]["spans"] if x not in out[i]["base"]) for i, _ in rows]
    assert got == _discover([t or "" for _, t in rows])
    return {i: [t[s:e] for s, _, e in found] for (i, t), found in zip(rows, got) if found}


def test_pii_finds_the_unseen_in_the_small_table(spark):
    rows = [(i, t) for i, t in small(spark)]
    assert _added(spark, rows)


def test_pii_learns_contexts(spark):
    """Cards follow the word ``paycard``; a number in that place that fails
    the check is found by its context, one in a common place is not."""
    cards = ["4111111111111111", "5500005555555559", "340000000000009", "30000000000004", "6011000000000004", "4012888888881881"]
    rows = [(i, f"please charge paycard {c} today or wait") for i, c in enumerate(cards)]
    rows += [(100 + i, f"the room {200 + i} is free") for i in range(30)]
    rows += [(200, "please charge paycard 4111-1111-1111-1112x today or wait"), (201, "the room 4111-1111-1111-1113x is free")]
    assert _added(spark, rows) == {200: ["4111-1111-1111-1112x"]}


def test_pii_finds_whole_identifiers(spark):
    """Runs of several tokens, secrets in any case behind punctuation, numbers
    that fail a check, identifiers side by side; versions and years stay."""
    rows = [(i, f"text {chr(97 + i)}: please call +1 ({700 + i}) 555-{3800 + 7 * i} now or later") for i in range(8)]
    rows += [(20, "then please call (743) 555-3824, or not"), (21, "they call in 2024 for version 4.0. or 3.11.2")]
    keys = [hashlib.sha1(bytes([i])).hexdigest() for i in range(7)]
    rows += [(30 + i, f'{"abcdefg"[i]} we set token = "{k}" there') for i, k in enumerate(keys)]
    rows += [(40, 'TOKEN = "AB12-98CD-77"!! and commit 77aa'), (41, "hash " + keys[0].upper() + "###")]
    good = ["4111111111111111", "5500005555555559", "6011000000000004", "4012888888881881", "5105105105105100"]
    rows += [(50 + i, f"{'vwxyz'[i]}o {c} {'mnopq'[i]}u") for i, c in enumerate(good)]
    rows += [(60, "one 9807915762804490 2353820953013749 two"), (61, "2353820953013749 was.91@mail6.example.com"), (62, "id 980791576280449 x")]
    got = _added(spark, rows)
    assert got[20] == ["(743) 555-3824"] and got[40] == ["AB12-98CD-77"] and got[41] == [keys[0].upper()]
    assert all(got[30 + i] == [k] for i, k in enumerate(keys))
    assert got[60] == ["9807915762804490", "2353820953013749"] and got[61] == ["2353820953013749"]
    assert not {21, 62} & set(got)


def test_pii_many_identifiers_in_one_text(spark):
    """The work for one text follows its number of identifiers."""
    one = lambda n: [(1, "".join(f"call +1 ({i % 900 + 100}) 555-{i % 9000 + 1000} or 98079157628{i % 90000 + 10000} so " for i in range(n)))]
    took = {}
    for n in (200, 2_000, 16_000):
        t0 = time.time()
        out = pii.extract(spark.createDataFrame(one(n), "doc_id long, text string")).select(F.size("base")).first()[0]
        took[n] = time.time() - t0
        assert out >= n
    assert took[16_000] < 8 * took[2_000] + 5


# --- token counts ----------------------------------------------------------


def _greedy(word, begin, inside):
    i = n = 0
    while i < len(word):
        pieces = inside if i else begin
        end = next((j for j in range(len(word), i, -1) if word[i:j] in pieces), None)
        if end is None:
            return -1
        i, n = end, n + 1
    return n


@given(st.data())
@settings(max_examples=150, deadline=None)
def test_automaton_is_greedy(data):
    piece = st.text(alphabet="abé", min_size=1, max_size=5).map(str.encode)
    begin, inside = data.draw(st.sets(piece, max_size=8)), data.draw(st.sets(piece, max_size=8))
    words = data.draw(st.lists(st.text(alphabet="abéc", min_size=1, max_size=12).map(str.encode), max_size=20))
    got = tokens.Automaton.of(begin, inside).count(pa.array(words, pa.large_binary()))
    assert got.tolist() == [_greedy(w, begin, inside) for w in words]


def test_token_counts(spark, odd, none):
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = SentencePieceProcessor(model_file=path)
    use = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    begin = {p[1:] for p in use if p[0] == "▁" and "▁" not in p[1:]}
    inside = {p for p in use if "▁" not in p}
    short = [(i, t) for i, t in ODD if len(t or "") < 50_000]
    for frame, texts in ((sf001(spark, "documents"), small(spark)), (odd.filter("text is null or length(text) < 50000"), short)):
        want = Counter()
        for i, t in texts:
            each = [_greedy(w, begin, inside) for w in words_of(t)]
            want[(i, len(each), sum(map(abs, each)), sum(x < 0 for x in each))] += 1
        got = tokens.count_tokens(frame, path).collect()
        assert by_rows(got, "doc_id", "n_words", "n_tokens", "n_unknown") == want
    assert tokens.count_tokens(odd, path).count() == len(ODD)
    assert tokens.count_tokens(none, path).count() == 0


# --- line dedup ------------------------------------------------------------


def _instances(rows, depth=4, min_docs=5, similarity=0.6):
    """Places (row, line) to drop, by the definition; equal rows are one
    document."""
    mask = lambda w: "<*>" if re.search("[0-9]", w) else w
    parsed = []
    for d, (_, text) in enumerate(rows):
        for k, line in enumerate(text.split("\n") if text is not None else []):
            ws = [mask(w) for w in re.findall(r"[^ \t\x0b\f\r]+", line)]
            if ws:
                parsed.append((d, k, (len(ws), *ws[:depth]), ws[depth:]))
    who = defaultdict(set)
    for d, _, leaf, later in parsed:
        for p, w in enumerate(later):
            who[leaf, p, w].add(rows[d])
    members, places = defaultdict(set), defaultdict(set)
    for d, k, leaf, later in parsed:
        constant = [len(who[leaf, p, w]) >= min_docs for p, w in enumerate(later)]
        if sum(constant) >= similarity * len(later):
            form = (leaf, *[w if c else "<*>" for c, w in zip(constant, later)])
            members[form].add(rows[d])
            places[form].add((d, k))
    key = lambda place: ((rows[place[0]][0] is not None, rows[place[0]][0] or 0), place[1])
    out = set()
    for form, docs in members.items():
        if len(docs) >= min_docs:
            first = min(places[form], key=key)
            out |= {x for x in places[form] if (rows[x[0]], x[1]) != (rows[first[0]], first[1])}
    return out


def test_line_dedup_small(spark):
    texts = sorted(small(spark))
    gone = _instances(texts)
    assert gone
    got = {r["doc_id"]: r for r in lines.drop_template_lines(sf001(spark, "documents")).collect()}
    for d, (i, t) in enumerate(texts):
        kept = [x for k, x in enumerate(t.split("\n")) if (d, k) not in gone]
        assert got[i]["text"] == "\n".join(kept)
        assert got[i]["n_dropped"] == sum(x == d for x, _ in gone)
        assert got[i]["lang"] is not None


def test_line_dedup_templates(spark):
    """Variable fields are generalised; the first instance stays; prose with
    the same leading words stays."""
    rows = [(i, f"own text number {'abcdefghij'[i]}\nuser alice{i} logged in from host h{i} port {i}") for i in range(10)]
    rows += [(20 + i, f"my own heading\nuser <*> logged in {'klmnopqr'[i]} a{'stuvwxyz'[i]} b{'stuvwxyz'[i]} c d") for i in range(3)]
    got = {r["doc_id"]: r["text"] for r in lines.drop_template_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == rows[0][1]
    assert all(got[i] == f"own text number {'abcdefghij'[i]}" for i in range(1, 10))
    assert all(got[i] == t for i, t in rows[10:])


def _dropped(spark, rows):
    """Lines that are left of each row, in order of id and text."""
    out = lines.drop_template_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    gone = _instances(rows)
    want = Counter()
    for d, (i, t) in enumerate(rows):
        kept = [x for k, x in enumerate(t.split("\n")) if (d, k) not in gone]
        want[(i, "\n".join(kept), len(t.split("\n")), sum(x == d for x, _ in gone))] += 1
    assert by_rows(out, "doc_id", "text", "n_lines", "n_dropped") == want
    return {r["doc_id"]: r["text"] for r in out}


def test_line_dedup_keeps_different_lines(spark):
    """Lines with a common opening and different ends are no instances."""
    rows = [(i, f"We went to the {w} house") for i, w in enumerate("red blue green white brown black".split())]
    assert _dropped(spark, rows) == dict(rows)
    # one document's five lines make no constant
    rows += [(50, "\n".join(f"We went to the {w} {x}" for w, x in zip("abcde", "vwxyz")))]
    rows += [(60 + i, f"We went to the {'klmno'[i]} v") for i in range(4)]
    _dropped(spark, rows)


def test_line_dedup_many_templates_in_a_leaf(spark):
    """Two templates share a leaf; the first instance of each stays, and rows
    that repeat a document count once and lose the same lines."""
    red = [(i, f"own {chr(97 + i)} text\nthe log says that job {'abcdefgh'[i]} has ended well today") for i in range(7)]
    blue = [(10 + i, f"own {chr(107 + i)} word\nthe log says that disk {'abcdefgh'[i]} was nearly full again") for i in range(6)]
    few = [(20 + i, f"the log says that node {'abcdefgh'[i]} could not be found") for i in range(4)]
    rows = red + blue + few + [red[3], red[3], blue[0], few[0]]
    got = _dropped(spark, rows)
    assert got[0] == red[0][1] and got[10] == blue[0][1]
    assert got[3] == "own d text" and got[12] == "own m word" and all(got[i] == t for i, t in few)


def test_line_dedup_random(spark):
    """Small vocabularies, so that leaves hold many lines and templates."""
    rng = random.Random(11)
    word = lambda: rng.choice(["a", "b", "c", "7", "x1"])
    rows = []
    for i in range(150):
        each = [" ".join(["to", "be", "or", "not"][: rng.randint(1, 4)] + [word() for _ in range(rng.randint(0, 5))]) for _ in range(rng.randint(1, 6))]
        rows.append((i or None, "\n".join(each) + f"\n{i}x own{'abc'[i % 3]} {chr(200 + i)}"))
    _dropped(spark, rows + rows[:20])


def test_line_dedup_cuts_each_text_once(spark):
    """The pipeline's stage builds the new text in one place, and cuts the old
    one outside of what runs per line; documents left without a word go."""
    import corpus_pipeline

    word = lambda i: f"own {chr(97 + i)}\n \n{BODY}"
    rows = [(i, word(i), 7) for i in range(6)] + [(10, BODY, 7), (11, f" \n{BODY}\n\t", 7), (12, " \n", 7), (13, "", 7), (14, None, 7), (None, f"x\n{BODY}", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    out = corpus_pipeline.line_dedup(spark, docs, "")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_join(") == 1 and "element_at(split(" not in plan
    want = {i: (f"own {chr(97 + i)}\n ", 7) for i in range(6)} | {12: (" \n", 7), 13: ("", 7), 14: (None, 7), None: (f"x\n{BODY}", 7)}
    want |= {i: (t, len(t)) for i, (t, _) in want.items() if i is not None and i < 6}
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()} == want
    left = lines.drop_template_lines(docs)
    assert {r["doc_id"]: r["text"] for r in left.collect()} == {i: t for i, (t, _) in want.items()} | {10: "", 11: " \n\t"}


def test_line_dedup_odd(spark, odd, none):
    got = lines.drop_template_lines(odd).collect()
    assert Counter((r["doc_id"], r["text"], r["doc"], r["kept"]) for r in got) == Counter((i, t, "doc", "kept") for i, t in ODD)
    many = odd.unionByName(spark.createDataFrame([(100 + i, BODY, "d", 1, 2, "k", 0.0, 1) for i in range(6)], odd.schema))
    out = lines.drop_template_lines(many.withColumn("n_lines", many["n"])).collect()
    assert len(out) == len(ODD) + 6
    # ids sort nulls first: the null id keeps the line, others lose it
    assert {r["doc_id"] for r in out if r["text"] == BODY} == {None}
    assert lines.drop_template_lines(none).count() == 0


def test_jaccard_chunk_memory():
    """A chunk's shingles take less than nine arrays of a 64-bit number per
    word at once (eleven when all were kept to the end)."""
    rng = np.random.default_rng(3)
    n, words = 400, 1500
    texts = [" ".join(map(str, rng.integers(0, 1 << 30, words))) for _ in range(n)] + ["a b c", "", "a"]
    table = pa.table({"doc": pa.array(range(len(texts)), pa.int64()), "text": texts})
    jaccard.shingles(table, 5)  # the powers that all chunks share are made once
    tracemalloc.start()
    try:
        one, two, starts = jaccard.shingles(table, 5)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert np.diff(starts).tolist() == [words - 4] * n + [1, 0, 1] and len(one) == len(two) == n * (words - 4) + 2
    assert peak < 9 * 8 * n * words, peak / (8 * n * words)


# --- quality rules ---------------------------------------------------------


def _stats(text):
    text = text or ""
    ws = words_of(text)
    where = defaultdict(list)
    for k in range(len(ws) - 7):
        where[tuple(ws[k : k + 8])].append(k)
    covered = {j for v in where.values() if len(v) > 1 for k in v for j in range(k, k + 8)}
    ls = [x for x in text.split("\n") if words_of(x)]
    failed = len(ws) < 20 or 100 * len(covered) > 30 * len(ws)
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), len(ls) - len(set(ls)), len(covered), failed


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_quality_statistics(spark, odd, none):
    for frame, texts in ((sf001(spark, "documents"), small(spark)), (odd, ODD)):
        got = quality.judge(frame, []).collect()
        assert by_rows(got, "doc_id", *COLUMNS) == Counter((i, *_stats(t)) for i, t in texts)
        assert all(r["kept"] == (not r["base_failed"]) for r in got)
    assert quality.judge(none, []).count() == 0
    assert quality.learn_rules(odd, spark.createDataFrame([], "doc_id long, quality int")) == []


def test_quality_rules_are_learned():
    rng = np.random.default_rng(3)
    x = {r[0]: rng.random(3000) for r in quality.RATIOS}
    bad = (x["upper_share"] > 0.7) & (x["symbols_per_word"] > 0.5) | (x["repeat_share"] > 0.95)
    rules = quality.learn(x, bad)
    hit = np.zeros(3000, bool)
    for rule in rules:
        hit |= quality.covers(rule, x)
    assert (hit & bad).sum() > 0.9 * bad.sum() and (hit & ~bad).sum() < 0.05 * hit.sum()
    assert quality.learn(x, np.zeros(3000, bool)) == []


def test_quality_held_out(spark):
    """Rules from the labelled half with even ids reject bad ones of the other
    half and keep the good ones."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    rules = quality.learn_rules(docs, labels.filter("doc_id % 2 = 0"))
    out = quality.judge(docs, rules).join(labels.filter("doc_id % 2 = 1"), "doc_id").select("quality", "kept").collect()
    good, bad = [r["kept"] for r in out if r["quality"]], [r["kept"] for r in out if not r["quality"]]
    assert sum(good) > 0.9 * len(good) and sum(bad) < 0.4 * len(bad)


# --- n-gram Jaccard join ---------------------------------------------------


def _classes(rows):
    lower = lambda t: re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
    sets = []
    for _, t in rows:
        ws = words_of(lower(t))
        sets.append({tuple(ws[k : k + 5]) for k in range(len(ws) - 4)} if len(ws) >= 5 else ({tuple(ws)} if ws else set()))
    who = defaultdict(list)
    parent = list(range(len(rows)))

    def root(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for a, s in enumerate(sets):
        shared = Counter(b for g in s for b in who[g])
        for b, n in shared.items():
            if 100 * n >= 80 * (len(s) + len(sets[b]) - n):
                parent[root(a)] = root(b)
        for g in s:
            who[g].append(a)
    least = {}
    big = 1 << 63
    for a in range(len(rows)):
        i = big if rows[a][0] is None else rows[a][0]
        least[root(a)] = min(least.get(root(a), big), i)
    return Counter((i, len(sets[a]), None if least[root(a)] == big else least[root(a)]) for a, (i, _) in enumerate(rows))


def test_jaccard_small(spark):
    got = jaccard.similar_classes(sf001(spark, "documents")).collect()
    assert by_rows(got, "doc_id", "n_shingles", "component_id") == _classes(small(spark))


def test_jaccard_odd(spark, odd, none):
    got = jaccard.similar_classes(odd).collect()
    assert by_rows(got, "doc_id", "n_shingles", "component_id") == _classes(ODD)
    assert jaccard.similar_classes(none).count() == 0


def test_jaccard_near_groups(spark):
    """Chains and stars of near copies around the threshold."""
    rng = random.Random(5)
    vocab = [f"v{i}" for i in range(400)]
    rows = []
    for g in range(6):
        base = [rng.choice(vocab) for _ in range(120)]
        for _ in range(40):
            one = list(base)
            for _ in range(rng.randint(0, 6)):
                one[rng.randrange(len(one))] = rng.choice(vocab)
            if rng.random() < 0.2:
                one = one[: rng.randint(90, 120)]
            if rng.random() < 0.3:
                base = one
            rows.append((len(rows) * 7 % 1009, " ".join(one)))
    got = jaccard.similar_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert by_rows(got, "doc_id", "n_shingles", "component_id") == _classes(rows)


def test_jaccard_repeated_ids(spark):
    """Equal texts under one id, several of them or none, with near copies:
    whichever row names the class, its links stay."""
    rng = random.Random(6)
    some = lambda n: [f"u{rng.randrange(10_000)}" for _ in range(n)]
    rows = []
    for g in range(12):
        text = some(100)
        near = " ".join([*text[:-3], *some(3)])
        text = " ".join(text)
        rows += [(None, text)] * 2 + [(1000 + g, near)]
        a, b = " ".join(sorted(some(60))), some(100)
        c = " ".join([*b[:-3], *some(3)])
        rows += [(g, a), (g, " ".join(b)), (500 + g, " ".join(b)), (2000 + g, c), (g, c)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = _classes(rows)
    assert by_rows(jaccard.similar_classes(frame).collect(), "doc_id", "n_shingles", "component_id") == want
    with pytest.MonkeyPatch.context() as patch:  # all rows in one chunk
        patch.setattr(jaccard, "chunks_for", lambda *_: 1)
        assert by_rows(jaccard.similar_classes(frame).collect(), "doc_id", "n_shingles", "component_id") == want


# --- decontamination -------------------------------------------------------


def test_decontamination(spark, none):
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(300)]
    some = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(k, some(40)) for k in range(5)] + [(5, some(8)), (6, ["so", "what"]), (7, None), (None, some(30))]
    bench = [(k, " ".join(ws) if ws else None, 1) for k, ws in items]
    swapped = list(items[1][1])
    for p in (3, 11, 19, 27, 35):
        swapped[p] = "changed"
    texts = {
        1: some(100) + items[0][1] + some(50),
        2: some(30) + swapped + some(30),
        3: some(60),
        4: some(20) + items[2][1][10:24] + some(20),
        5: some(20) + items[2][1][10:20] + some(20),
        6: some(10) + items[5][1] + some(10),
        7: ["so", "what"],
        8: [w.upper() + "," for w in items[3][1]],
        9: some(5) + items[8][1] + some(5),
    }
    docs = spark.createDataFrame([(i, " ".join(ws), "x") for i, ws in texts.items()] + [(20, None, "x"), (21, "", "x")], "doc_id long, text string, item_id string")
    bench_df = spark.createDataFrame(bench, "item_id long, text string, n int")
    got = {(r["doc_id"], r["item_id"]): (r["start"], r["end"], r["n_equal"]) for r in decontaminate.find_overlaps(docs, bench_df).collect()}
    assert {k for k in got} == {(1, 0), (2, 1), (4, 2), (6, 5), (8, 3), (9, None)}
    assert got[1, 0][0] <= 100 and got[1, 0][1] >= 140 and got[2, 1][2] >= 35
    left = decontaminate.remove_contaminated(docs, bench_df)
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == {3, 5, 7, 20, 21}
    assert decontaminate.find_overlaps(none, bench_df).count() == 0
    empty = bench_df.limit(0)
    assert decontaminate.find_overlaps(docs, empty).count() == 0
    assert decontaminate.remove_contaminated(docs, empty).count() == docs.count()


def test_decontamination_of_short_items(spark):
    """Items of few words: left out by default, found when asked for."""
    docs = spark.createDataFrame([(1, "we saw a blue moon rise"), (2, "nothing here")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "Blue moon!"), (8, "rise"), (9, "")], "item_id long, text string")
    assert decontaminate.find_overlaps(docs, items).count() == 0
    got = decontaminate.find_overlaps(docs, items, min_item=1).collect()
    assert sorted(tuple(r) for r in got) == [(1, 7, 3, 5, 2), (1, 8, 5, 6, 1)]
    assert [r["doc_id"] for r in decontaminate.remove_contaminated(docs, items, min_item=1).collect()] == [2]


def test_decontamination_in_blocks(spark, monkeypatch):
    bench, docs = sf001(spark, "benchmark"), sf001(spark, "documents")
    one = by_rows(decontaminate.find_overlaps(docs, bench).collect(), "doc_id", "item_id", "start", "end")
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 300)
    assert one and by_rows(decontaminate.find_overlaps(docs, bench).collect(), "doc_id", "item_id", "start", "end") == one


def test_masks_hit_every_pattern():
    """All choices of replaced words in overlaps of 13 to 25 words leave a
    seed whole; longer ones hold one of these."""
    for n in range(13, 26):
        patterns = np.array([sum(1 << i for i in c) for c in itertools.combinations(range(n), n * 20 // 100)])
        hit = np.zeros(len(patterns), bool)
        for mask in decontaminate.masks_for(13, 80):
            bits = sum(1 << i for i, b in enumerate(mask) if b == "1")
            for at in range(n - len(mask) + 1):
                hit |= patterns & (bits << at) == 0
        assert hit.all(), n


def _overlaps(items, text, min_words, percent):
    """Maximal stretches of all alignments, by trying every stretch; a short
    item must occur whole."""
    out = set()
    asked = min_words, percent
    for k, item in enumerate(items):
        min_words, percent = asked if len(item) >= asked[0] else (len(item), 100)
        for shift in range(1 - len(item), len(text)):
            a, b = max(shift, 0), min(shift + len(item), len(text))
            same = [text[t] == item[t - shift] for t in range(a, b)]
            run = np.concatenate([[0], np.cumsum(same)])
            if run[-1] * 100 < min_words * percent:
                continue
            good = [
                (i, j)
                for i in range(len(same))
                for j in range(i + min_words, len(same) + 1)
                if same[i] and same[j - 1] and (run[j] - run[i]) * 100 >= percent * (j - i)
            ]
            whole = [x for x in good if not any(y != x and y[0] <= x[0] and x[1] <= y[1] for y in good)]
            out |= {(k, a + i, a + j, int(run[j] - run[i])) for i, j in whole}
    return out


@pytest.mark.parametrize("min_words, percent", [(13, 80), (15, 90), (8, 70)])
def test_overlaps_match_brute_force(min_words, percent):
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(500)]
    some = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [some(n) for n in (13, 15, 20, 25, 40, 60, 90)]
    texts = []
    for item in items:
        for step in range(3, 9):  # every so many words replaced
            for first in range(step):
                texts.append(some(5) + [f"x{i}" if i % step == first else w for i, w in enumerate(item)] + some(5))
        for _ in range(30):  # at random, in a part of the item
            part = list(item[rng.randrange(len(item) // 3) :])
            for i in rng.sample(range(len(part)), len(part) // 5):
                part[i] = "x"
            texts.append(some(4) + part)
        texts.append(item[:14] + ["y"] * max(0, len(item) - 28) + item[-14:])  # two stretches of one alignment
    index = decontaminate.Index.of(list(range(len(items))), [" ".join(x).encode() for x in items], min_words, percent)
    found = decontaminate.overlaps_of(index, W.as_binary(pa.array([" ".join(t) for t in texts])))
    assert len(found) == len(set(found))
    got = defaultdict(set)
    for row, *rest in found:
        got[row].add(tuple(rest))
    for row, text in enumerate(texts):
        assert got[row] == _overlaps(items, text, min_words, percent), row


# --- toxicity --------------------------------------------------------------


def test_machine_learns_an_interaction():
    """Two terms that are harmless alone and toxic together."""
    rng = np.random.default_rng(4)
    x = rng.random((4000, 20)) < 0.3
    y = (x[:, 0] & x[:, 1]).astype(float)
    row, term = np.nonzero(x)
    machine = toxicity.fit(row, term.astype(np.int64), y, epochs=40)
    p = machine.score(row, term, 4000)
    assert ((p >= 0.5) == (y == 1)).mean() > 0.98


def test_scores_match_a_naive_pair_sum(spark):
    """The score against the definition: base, weights, and the inner product
    of the factors for each pair of terms."""
    docs, labels = sf001(spark, "documents"), sf001(spark, "labels").select("doc_id", "toxic")
    machine = toxicity.train(docs, labels)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, machine).collect()}
    for i, text in small(spark)[::7]:
        _, buckets = toxicity.terms(pa.array([(text or "").encode()], pa.large_binary()))
        known = [machine.slot[b] for b in buckets if machine.slot[b] >= 0]
        z = machine.base + sum(machine.weights[t] for t in known)
        z += sum(float(machine.factors[a] @ machine.factors[b]) for a, b in itertools.combinations(known, 2))
        assert abs(got[i] - 1 / (1 + np.exp(-max(-30, min(30, z))))) < 1e-9


def test_training_finds_a_pair_of_neutral_terms(spark):
    """Toxic when exactly one of two words occurs: neither depends on the
    label alone, so a screen by single terms must not cut them off."""
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(4000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        words = [rng.choice("oak elm ash fir yew".split()) for _ in range(4)] + ["kettle"] * a + ["violin"] * b
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(a != b)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    machine = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    scored = {r["doc_id"]: r["score"] for r in toxicity.score(docs, machine).collect()}
    held = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 5 == 0]
    right = sum((scored[i] >= 0.5) == bool(labels[i][1]) for i in held)
    assert right > 0.95 * len(held)


def test_toxicity_held_out(spark, odd, none):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    machine = toxicity.train(docs, labels)
    scored = toxicity.score(docs, machine).withColumn("held", toxicity.held_out(toxicity.F.col("doc_id")))
    rows = scored.join(labels, "doc_id").filter("held").select("doc_id", "score", "toxic").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in rows)
    one, zero = [r["score"] for r in rows if r["toxic"]], [r["score"] for r in rows if not r["toxic"]]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in one for b in zero])
    assert auc > 0.7
    out = toxicity.score(odd, machine).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(i for i, _ in ODD)
    assert all(0 <= r["score"] <= 1 for r in out)
    assert toxicity.score(none, machine).count() == 0
    blank = toxicity.train(docs, labels.limit(0))
    assert {r["score"] for r in toxicity.score(odd, blank).collect()} == {0.5}


# --- substring dedup -------------------------------------------------------


def _kept(rows, size=20):
    seen, out = set(), Counter()
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, (r[1] or "").encode()))
    for i, t in order:
        ws = words_of(t)
        covered = [False] * len(ws)
        for k in range(len(ws) - size + 1):
            window = tuple(ws[k : k + size])
            if window in seen:
                covered[k : k + size] = [True] * size
            seen.add(window)
        left = " ".join(w for w, c in zip(ws, covered) if not c)
        out[(i, len(ws), sum(covered), hashlib.sha256(left.encode()).hexdigest())] += 1
    return out


def _digest(rows):
    return Counter((r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in rows)


def test_substrings(spark, odd, none):
    assert _digest(substrings.drop_repeats(sf001(spark, "documents")).collect()) == _kept(small(spark))
    assert _digest(substrings.drop_repeats(odd).collect()) == _kept(ODD)
    assert substrings.drop_repeats(none).count() == 0


def test_sketch_loses_none(spark):
    """A sketch far too narrow flags more windows, and the result is the same."""
    rng = random.Random(1)
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join([f"w{rng.randrange(50)}" for _ in range(30)] + passage[rng.randrange(20) :])) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert _digest(substrings.drop_repeats(frame).collect()) == _kept(rows)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(substrings.Shape, "of", classmethod(lambda cls, n, width: cls(2, 1, 4)))
        assert _digest(substrings.drop_repeats(frame).collect()) == _kept(rows)
