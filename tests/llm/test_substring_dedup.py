import random

from hypothesis import given, settings
from hypothesis import strategies as st

from wayframe.llm import substring_dedup as sd


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab. !\n\té", max_size=200))
def test_units_are_the_whole_text(text):
    parts = sd.units(text)
    assert "".join(text[s:e] for s, e, _, _ in parts) == text
    assert sum(n for _, _, n, _ in parts) == len(text.encode().split())


def brute(rows):
    """Removal with sets of whole span strings in place of hashes and joins."""
    first, out = {}, {}

    def of(t):
        parts = sd.units(t)
        return parts, [(i, j, tuple(" ".join(t[s:e].split()) for s, e, _, _ in parts[i:j])) for i, j, _ in sd.spans(parts)]

    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        for _, _, s in of(t or "")[1]:
            first.setdefault(s, i)
    for i, t in rows:
        if i is None or t is None:
            continue
        parts, found = of(t)
        gone, seen = set(), set()
        for a, b, s in found:
            if first[s] < i or s in seen:
                gone.update(range(a, b))
            seen.add(s)
        out[i] = "".join(t[p[0] : p[1]] for k, p in enumerate(parts) if k not in gone)
    return out


def sentence(rnd, n=None):
    return " ".join(rnd.choice("abcdefghij") + str(rnd.randrange(500)) for _ in range(n or rnd.randrange(2, 14))).capitalize() + "."


def test_against_brute_force(spark):
    rnd = random.Random(1)
    passages = [" ".join(sentence(rnd) for _ in range(9)) for _ in range(4)] + [sentence(rnd, 70)]
    rows = []
    for i in range(120):
        text = [sentence(rnd) for _ in range(rnd.randrange(0, 15))]
        for _ in range(rnd.choice([0, 0, 1, 2])):
            text.insert(rnd.randrange(len(text) + 1), rnd.choice(passages) + rnd.choice(["", "\n"]))
        rows.append((i, rnd.choice([" ", "\n"]).join(text)))
    rows += [(500, None), (501, ""), (502, "word " * 30_000), (503, passages[0] + " " + passages[0])]
    docs = spark.createDataFrame([(i, t, 7, "s") for i, t in [*rows, (None, passages[0])]], "doc_id long, text string, n_removed int, span string").repartition(4)
    got = {r.doc_id: r for r in sd.remove_repeats(docs).collect()}
    want = brute(rows)
    assert {i: r.text for i, r in got.items() if i is not None and i != 500} == want
    assert got[500].text is None and got[None].text == passages[0] and got[3].span == "s"
    assert any(r.n_removed for r in got.values())
    for p in passages:
        assert sum((r.text or "").count(p) for i, r in got.items() if i is not None) <= 1
    assert sd.remove_repeats(docs.limit(0)).count() == 0


def test_passage_inside_a_sentence(spark):
    rnd = random.Random(4)
    passage = " ".join(sentence(rnd, 12) for _ in range(6))
    rows = [(i, f"{sentence(rnd)} alpha{i} beta{i} {passage} {sentence(rnd)}") for i in range(20)]
    got = {r.doc_id: r for r in sd.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    inner = passage.split(". ")[3]
    assert [i for i, r in got.items() if inner in r.text] == [0]
    assert all(f"alpha{i} beta{i}" in r.text for i, r in got.items())


def test_repeated_rows_are_one_document(spark):
    rnd = random.Random(9)
    text = " ".join(sentence(rnd, 9) for _ in range(8))
    got = sd.remove_repeats(spark.createDataFrame([(1, text), (1, text), (2, text)], "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.text == text, r.n_removed > 0) for r in got) == [(1, True, False), (1, True, False), (2, False, True)]


def test_every_passage_of_51_words_holds_a_span():
    rnd = random.Random(7)
    words = lambda n: [rnd.choice("abcdefghij") + str(rnd.randrange(500)) for _ in range(n)]
    for k in range(1500):
        ends = k % 3  # none, few, ordinary sentences
        passage = [w + "." * (ends > 0 and rnd.random() < (0, 0.04, 0.12)[ends]) for w in words(51)]
        if k % 2:
            passage[-1] += "."
        hosts = [" ".join([*words(rnd.randrange(0, 40)), *passage, *words(rnd.randrange(0, 40))]) for _ in range(2)]
        first = {h for _, _, h in sd.spans(sd.units(hosts[0]))}
        left, _, lost = sd.remove(hosts[1], first)
        assert lost, passage
        assert len(hosts[1].split()) - len(left.split()) >= 24
