"""Spelling variants, collocations and personal data against brute force, with the awkward cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from corpusloom.llm import collocations, pii, queries, variants
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, spans string, n_email string, word string, phrase string"


def rows_of(texts, langs=("en", None)):
    rows = [(i, t, langs[i % len(langs)], "clash", "clash", "clash", "clash") for i, t in enumerate(texts)]
    return [*rows, rows[0], (None, "no number at all", "de", None, None, None, None)]


def frame(spark, texts, **options):
    return spark.createDataFrame(rows_of(texts, **options), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# Personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_check(digits):
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = digit * (1 + place % 2)
        total += value // 10 + value % 10
    return total % 10 == 0


def plain_spans(text):
    found = {}
    for kind, pattern in PATTERNS.items():
        found[kind] = []
        for match in re.finditer(pattern, text):
            digits = [int(c) for c in match.group() if c.isascii() and c.isdigit()]
            good = {
                "email": True,
                "ip": kind == "ip" and all(len(p.lstrip("0")) < 4 and int(p[-3:]) <= 255 for p in match.group().split(".")),
                "card": 13 <= len(digits) <= 19 and plain_check(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                found[kind].append(match.span())
    return found


def test_base_spans_equal_the_patterns():
    draw = random.Random(4)
    fixed = [
        "", "a@b.c@d.e", "a@b.c.@d.e", "1.2.3.4.5.6.7.8.9", "0000.1.2.255 256.1.1.1", "1" * 30_000 + ".2.3.4", "4111 1111-1111 1111 x 4111111111111112",
        "+49 (0) 123.456-78- +1+2345678901 +12 ", "é@ü.de x@ü.de", "+1 234 567 890 12 34", "😀 a@b.co 1.1.1.1",
    ]
    for text in [*fixed, *("".join(draw.choices("ab1234560..@@-+ ()é😀٣\n", k=draw.randint(0, 60))) for _ in range(20_000))]:
        got = pii.find_spans(text)
        assert {k: got[k] for k in pii.BASE} == plain_spans(text), text


def test_added_spans():
    def kinds(text):
        return {k: [text[a:b] for a, b in found] for k, found in pii.find_spans(text).items() if found and k in pii.ADDED}

    assert kinds("ask jörg@müller.de now") == {"mail": ["jörg@müller.de"]}
    assert kinds("ask ann.lee [at] mail [dot] org, or Bob(AT)x.com") == {"mail": ["ann.lee [at] mail [dot] org", "Bob(AT)x.com"]}
    assert kinds("see https://ann:pw@host/x and http://site.org/users/ann. But http://site.org/about not") == {
        "profile": ["https://ann:pw@host/x", "http://site.org/users/ann"]
    }
    assert kinds("IBAN: DE89 3704 0044 0532 0130 00 ok; iban DE00370400440532013000 wrong") == {"iban": ["DE89 3704 0044 0532 0130 00"]}
    assert kinds("SSN 123-45-6789, ssn: 000-12-3456, lessn 123-45-6789") == {"ssn": ["123-45-6789"]}
    assert kinds("Account no. 12 345 678; account 12; accounts 123456789") == {"account": ["12 345 678"]}


def test_find(spark, empty):
    long = "word " * 500_000 + "a@b.org +49 123 456 789"
    texts = ["", None, " ", "x", long, "mail a@b.org, 10.0.0.1 and 4111 1111 1111 1111", "ssn 123-45-6789"]
    data = frame(spark, texts)
    got = pii.find(data).collect()
    assert len(got) == data.count() and pii.find(data).columns[:7] == data.columns
    assert pii.find(data).columns[7:] == ["base", "spans_", "redacted", "n_email_", "n_ip", "n_card", "n_phone"]
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].redacted is None and by_id[1].base == "" and by_id[0].redacted == ""
    assert by_id[4].n_email_ == 1 and by_id[4].n_phone == 1 and by_id[4].redacted.endswith("[EMAIL] [PHONE]")
    assert by_id[5].redacted == "mail [EMAIL], [IP] and [CARD]" and by_id[6].redacted == "ssn [SSN]"
    assert by_id[6].base == "" and by_id[6].spans_ == "ssn:4:15"
    assert pii.find(empty).count() == 0


def test_pii_query(spark, docs):
    got = {r.doc_id: r for r in queries.op13_pii(spark, SF).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for row in rows:
        spans = plain_spans(row.text or "")
        listed = ",".join(f"{k}:{a}:{b}" for k in PATTERNS for a, b in spans[k])
        r = got[row.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(spans[k]) for k in PATTERNS]
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()


# Spelling variants


def plain_words(rows, least_length=7, least=2):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= least_length
    return {w: n for w, n in counts.items() if n >= least}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(rows, ratio=10):
    n = plain_words(rows)
    # Words that are near share the text left of one place and the text right of it.
    places = defaultdict(set)
    for word in n:
        for i in range(len(word) + 1):
            places[word[:i], word[i:]].add(word)
            places[word[:i], word[i + 1 :]].add(word)
    near = defaultdict(set)
    for group in places.values():
        for word in group:
            near[word] |= {w for w in group if w != word and one_edit(w, word)}
    form = {}
    for word in n:
        best = min(near[word], key=lambda w: (-n[w], w), default=None)
        if best is not None and n[best] >= ratio * n[word]:
            form[word] = best
    found = []
    for word in n:
        root = word
        while root in form:
            root = form[root]
        found.append((word, form.get(word), root, n[word], len(near[word]), n[form[word]] if word in form else None))
    return sorted(found, key=lambda r: r[0])


def test_search_equals_comparing_all():
    draw = random.Random(3)
    for _ in range(150):
        letters = draw.choice(["ab", "abc", "abcdé😀"])
        words = sorted({"".join(draw.choices(letters, k=draw.randint(draw.choice([1, 2, 5]), 9))) for _ in range(draw.randint(1, 80))})
        asked = sorted({"".join(draw.choices(letters + "z", k=draw.randint(1, 9))) for _ in range(20)} | set(words))
        both, sides = asked * 2, np.repeat([variants.RIGHT, variants.LEFT], len(asked))
        index = variants.VocabularyIndex(words)
        for kinds, difference_ in ((7, (-1, 0, 1)), (variants.SAME, (0,)), (variants.LONGER, (1,)), (variants.SHORTER, (-1,))):
            q, w = variants.near_pairs(index, words, both, np.full(len(both), kinds), sides)
            got = sorted((both[i], words[j]) for i, j in zip(q.tolist(), w.tolist()))
            assert got == sorted((a, b) for a in asked for b in words if one_edit(a, b) and len(b) - len(a) in difference_)


def spelling_texts():
    draw = random.Random(8)
    stems = ["straßenbahn", "wonderful", "Élégance", "aaaaaaaa", "mississippi", "x" * 300]
    texts = []
    for stem in stems:
        texts += [" ".join([stem] * 130)]
        for _ in range(12):
            at, kind = draw.randrange(len(stem)), draw.randrange(3)
            other = stem[:at] + draw.choice("abé") * (kind > 0) + stem[at + (kind < 2) :]
            texts += [f"{other}, {other} {other[:at] + other[at + 1:]} {other[:at] + other[at + 1:]}"]
    return [*texts, "", None, "12 - 34", "short"]


def test_variants(spark, empty):
    data = frame(spark, spelling_texts())
    want = plain_variants([(r.doc_id, r.text) for r in data.collect()])
    assert sum(w[1] is not None for w in want) > 20
    assert sorted((tuple(r) for r in variants.variants(data).collect()), key=lambda r: r[0]) == want
    assert variants.variants(empty).count() == 0 and variants.variants(empty).columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_very_long_words(spark):
    word, ids = "wonderful" * 30_000, iter(range(100))

    def whole(text):
        # An id with which the run stays as it is.
        return next(i for i in ids if zlib.crc32(f"{i}:{text}".encode()) % 31)

    rows = [(whole(word), word) for _ in range(10)] + [(whole(word[:-1]), word[:-1] + " " + "word " * 400_000)] * 2
    got = {len(r.word): r for r in variants.variants(spark.createDataFrame(rows, "doc_id long, text string"), ratio=5).collect()}
    assert {k: (r.n, r.n_near) for k, r in got.items()} == {len(word): (10, 1), len(word) - 1: (2, 1)}
    assert got[len(word) - 1].form == got[len(word) - 1].root == word and got[len(word)].form is None
    with pytest.raises(ValueError, match="ratio"):
        variants.variants(spark.createDataFrame(rows, "doc_id long, text string"), ratio=1)


def test_forms_are_followed_to_the_last(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(20)]
    got = variants.roots_of(spark.createDataFrame(chain, "word string, form string")).collect()
    assert {r.word: r.root for r in got} == {w: "w20" for w, _ in chain}


def test_a_hot_shard_is_cut_into_a_grid(spark):
    # A third of all words share both ends.
    draw = random.Random(5)
    words = {f"unt{''.join(draw.choices('abc', k=4))}ung": 2 for _ in range(300)} | {"".join(draw.choices("abcde", k=8)): 3 for _ in range(300)}
    table = spark.createDataFrame([*words.items()], "word string, n long")
    total = defaultdict(int)
    for r in variants.near_words(table, shard=2_000, most=300, query_most=500).collect():
        total[r.word] += r.near
    assert dict(total) == {a: k for a in words if (k := sum(one_edit(a, b) for b in words))}


def test_variants_query(spark, docs):
    want = plain_variants([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert sorted((tuple(r) for r in queries.op11_variants(spark, SF).collect()), key=lambda r: r[0]) == want


# Collocations


def plain_phrases(rows, longest=3, least=10, covered=50, top=2_000):
    counts, total, found = defaultdict(Counter), Counter(), []
    for lang, text in rows:
        lang = lang or "und"
        text = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    for lang, f in counts.items():
        many = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in many.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(inside[p[i : i + k]], a)
        ranked = []
        for p, a in many.items():
            if not (p in inside and 100 * inside[p] >= covered * a):
                score, cut = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p), f[p[:cut]], f[p[cut:]], cut))
        for rank, (score, a, phrase, left, right, cut) in enumerate(sorted(ranked)[:top], 1):
            found.append((lang, rank, phrase, -a, left, right, total[lang], -score, cut))
    return sorted(found)


def phrase_texts():
    draw = random.Random(6)
    words = ["New", "york", "city", "the", "É", "of", "a\x1cb", "😀", "Z", "x" * 3000, "it's"]
    texts = ["".join(draw.choice(words) + draw.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ",", ""]) for _ in range(120)) for _ in range(60)]
    return [*texts, "", None, "...", " \t ", "alone", "deep in the wood " * 20_000]


@pytest.mark.parametrize("longest", [2, 3, 4, 5])
def test_phrases(spark, longest):
    data = frame(spark, phrase_texts(), langs=("en", None, "de"))
    want = plain_phrases([(r.lang, r.text) for r in data.collect()], longest)
    assert len(want) > 50
    for shard_words in (500, 1_000_000):
        assert sorted(tuple(r) for r in collocations.mine(data, longest, shard_words=shard_words).collect()) == want


def test_phrases_of_no_and_few_rows(spark, empty):
    assert collocations.mine(empty).count() == 0
    assert collocations.mine(frame(spark, ["", None, "once only"])).count() == 0
    best = collocations.mine(frame(spark, phrase_texts()), top=3)
    assert sorted(tuple(r) for r in best.collect()) == plain_phrases([(r[2], r[1]) for r in rows_of(phrase_texts())], top=3)


def test_long_texts_are_sliced_without_loss():
    text = "ab cd. ef\tgh " * 1000 + "w" * 500 + " end"
    whole = [w for part in collocations.slices(text.encode(), 1 << 30) for w in part]
    for size in (1, 7, 100):
        assert [w for part in collocations.slices(text.encode(), size) for w in part] == whole


def test_intervals_hold_the_occurrences():
    draw = np.random.default_rng(2)
    text = np.concatenate([[0], draw.integers(0, 6, 400), [0]])
    index = collocations.WordIndex(text, forward=3, backward=3)
    word, forward, backward, size = index.single()
    grams = [(w,) for w in word.tolist()]
    for grow, left in ((index.grow_right, False), (index.grow_left, True)):
        phrase, word, forward, backward, size = grow(forward, backward, size)
        grams = [(w, *grams[p]) if left else (*grams[p], w) for p, w in zip(phrase.tolist(), word.tolist())]
    listed = text.tolist()
    plain = Counter(tuple(listed[i : i + 3]) for i in range(len(listed) - 2))
    assert dict(zip(grams, size.tolist())) == {g: n for g, n in plain.items() if 0 not in g}
    places = {g: (listed[-1:] + listed)[i] for i in range(len(listed) - 2) if (g := tuple(listed[i : i + 3])) and plain[g] == 1 and 0 not in g}
    for gram, start in zip(grams, forward.tolist()):
        if gram in places:
            assert index.before[start] == places[gram]


def test_collocations_query(spark):
    assert difference(queries.op12_collocations(spark, SF), connect(SF), queries.ORACLE["op12_collocations"]) is None
