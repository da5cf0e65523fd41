from millrace.llm import passages as m


def jaccard(a, b, k=5):
    grams = lambda t: {tuple(t.lower().split()[i : i + k]) for i in range(len(t.split()) - k + 1)}
    return len(grams(a) & grams(b)) / len(grams(a) | grams(b))


def sentence_text(words, n, seed):
    w = words(n, seed)
    return " ".join(x + ("." if i % 8 == 7 else "") for i, x in enumerate(w))


def test_near_paragraphs_equal_brute_force(frame, words):
    rows, lines = [], []
    for g in range(15):
        base = words(60, g)
        for s, every in enumerate((0, 12, 30, 55)):
            w = [f"n{s}" if every and i % every == 3 else x for i, x in enumerate(base)]
            lines.append((len(rows), " ".join(w)))
            rows.append((len(rows), " ".join(words(40, 900 + len(rows))) + "\n" + " ".join(w), "en", "s", 0))
    alike = {i for i, a in lines for j, b in lines if i != j and jaccard(a, b) >= 0.8}
    got = {r.doc_id for r in m.repeats(frame(rows)).where("kind = 'paragraph'").collect()}
    assert got <= alike and len(alike - got) <= 0.03 * len(alike)


def test_passage_inside_lines_is_found_and_cut(frame, words):
    passage = sentence_text(words, 64, 1)
    rows = [(i, sentence_text(words, 50, 100 + i) + " " + passage + " " + sentence_text(words, 50, 200 + i), "en", "s", 0) for i in range(6)]
    rows += [(50 + i, sentence_text(words, 120, 300 + i), "en", "s", 0) for i in range(20)]
    got = m.repeats(frame(rows)).collect()
    assert {r.doc_id for r in got} == set(range(6)) and {r.class_id for r in got} == {0}
    assert [r.doc_id for r in got if r.kept] == [0]
    for r in got:
        assert rows[r.doc_id][1][r.start : r.end] in passage and r.n_words >= 40
    cut = {r.doc_id: r.text for r in m.without_repeats(frame(rows)).collect()}
    assert cut[0] == rows[0][1] and cut[50] == rows[6][1]
    assert all(len(cut[i]) < len(rows[i][1]) - 150 for i in range(1, 6))


def test_one_occurrence_of_every_sentence_stays(frame, words):
    a, b, between = (sentence_text(words, n, seed) for n, seed in ((32, 1), (32, 2), (8, 3)))
    about = lambda i: sentence_text(words, 48, 100 + i)
    bodies = [a, a + " " + b, b, a + " " + between + " " + b]
    rows = [(i, about(i) + " " + body + " " + about(50 + i), "en", "s", 0) for i, body in enumerate(bodies, 1)]
    cut = {r.doc_id: r.text for r in m.without_repeats(frame(rows)).collect()}
    for passage in (a, b):
        for sentence in passage.split(". "):
            assert sum(sentence.rstrip(".") in t for t in cut.values()) == 1
    assert a in cut[1] and b in cut[2] and a not in cut[2] and between in cut[4]


def test_a_sentence_kept_in_a_line_that_goes_stays_elsewhere(frame, words):
    base = words(200, 5)
    line = lambda x: " ".join([*base[:100], x, *base[100:]])
    own = sentence_text(words, 32, 9)
    rows = [(1, " ".join(base), "en", "s", 0), (2, line("end. " + own), "en", "s", 0), (3, sentence_text(words, 40, 70) + " " + own + " " + sentence_text(words, 40, 71), "en", "s", 0)]
    cut = {r.doc_id: r.text for r in m.without_repeats(frame(rows)).collect()}
    assert base[0] + " " + base[1] not in cut[2] and own in cut[3]


def test_anything_goes(oddities, nothing):
    got = m.repeats(oddities)
    assert all(r.doc_id is not None for r in got.collect())
    kept = m.without_repeats(oddities)
    assert kept.columns == oddities.columns and kept.count() == oddities.count()
    assert m.repeats(nothing).count() == 0 and m.without_repeats(nothing).count() == 0


def test_bands_reach_the_recall():
    for recall in (0.9, 0.985, 0.999):
        b = m.bands_for(recall)
        assert 1 - (1 - 0.8**3) ** b >= recall > 1 - (1 - 0.8**3) ** (b - 1)
