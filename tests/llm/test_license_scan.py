import random
import re

import pytest

from borelog.llm.license_scan import CONTAINMENT, TEMPLATES, anchor_pattern, anchors, license_scan, size_classes, template_shingles, template_words


def brute(text):
    words, found = template_words(text or ""), set()
    for longest, names in size_classes(TEMPLATES).items():
        step, size = max(1, longest // 2), longest + max(1, longest // 2)
        for name in names:
            own = set(template_shingles(template_words(TEMPLATES[name])))
            shares = [len(own & set(template_shingles(words[s : s + size]))) / len(own) for s in range(0, len(words), step)]
            if max(shares, default=0) >= CONTAINMENT:
                found.add(name)
    return found


def test_every_match_holds_an_anchor():
    chosen = set(anchors(TEMPLATES, CONTAINMENT))
    pattern = anchor_pattern(sorted(chosen))
    for text in TEMPLATES.values():
        own = template_shingles(template_words(text))
        assert sum(s not in chosen for s in own) < CONTAINMENT * len(own)
        assert re.search(pattern, re.sub("[^a-z0-9]+", " - ", text.lower()))


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(frame, seed):
    rng, rows = random.Random(seed), []
    for i in range(60):
        words = [rng.choice(["alpha", "beta", "license", "software", "under"]) for _ in range(rng.randint(0, 80))]
        text = rng.choice(list(TEMPLATES.values())).split()
        for _ in range(rng.randint(0, 2)):
            text[rng.randrange(len(text))] = "changed"
        rows.append((i, " ".join(words + text + words[:7])))
    found = {r.doc_id: {m.name for m in r.matches} for r in license_scan(frame(rows)).collect()}
    assert found == {i: brute(t) for i, t in rows}


def test_edge_cases(frame):
    notice = "RELEASED under the MIT license!"
    rows = [(1, None), (2, ""), (None, notice), (3, notice), (3, notice), (4, "word " * 60_000 + notice), (5, "license"), (6, notice + "\n" + notice)]
    found = [(r.doc_id, [(m.name, m.containment, m.start) for m in r.matches]) for r in license_scan(frame(rows)).collect()]
    by_id = dict(found)
    assert len(found) == len(rows) and by_id[1] == by_id[2] == by_id[5] == []
    assert by_id[None] == by_id[3] == by_id[6] == [("mit-notice", 1.0, 0)]
    assert by_id[4][0][:2] == ("mit-notice", 1.0) and license_scan(frame([])).collect() == []


def fullest(words, own, length):
    """The largest share of the template's shingles in any run of so many words, from any word on."""
    triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    runs = range(max(1, len(triples) - length + 3))
    return max((len(own.intersection(triples[s : s + length - 2])) / len(own) for s in runs), default=0)


def test_recall_over_all_positions(spark, frame):
    """All passages as long as their template, from any word on, that hold enough of it are found; and what is found is
    held by some passage three times as long. Nothing here is shared with the operator but the texts and the threshold."""
    rng, rows, wanted, allowed = random.Random(9), [], set(), set()
    split = lambda text: re.findall("[a-z0-9]+", text.lower())
    for i in range(120):
        text, name = [rng.choice(["river", "stone", "the", "software", "license"]) for _ in range(rng.randint(0, 300))], rng.choice(sorted(TEMPLATES))
        passage = re.findall(r"\S+", TEMPLATES[name])
        for _ in range(rng.randint(0, max(1, len(passage) // 12))):
            at = rng.randrange(len(passage))
            passage[at : at + 1] = rng.choice([[], ["changed"], [passage[at], "added"]])
        at = rng.randint(0, len(text))
        rows.append((i, "\n* ".join([" ".join(text[:at]), " ".join(passage).upper(), " ".join(text[at:])])))
        for other, template in TEMPLATES.items():
            ours = split(template)
            own, words = {tuple(ours[j : j + 3]) for j in range(len(ours) - 2)}, split(rows[-1][1])
            wanted |= {(i, other)} if fullest(words, own, len(ours)) >= CONTAINMENT else set()
            allowed |= {(i, other)} if fullest(words, own, 3 * len(ours)) >= CONTAINMENT else set()
    found = {(r.doc_id, m.name) for r in license_scan(frame(rows)).collect() for m in r.matches}
    assert len(wanted) > 100 and found <= allowed
    assert len(found & wanted) >= 0.99 * len(wanted)


def test_long_texts_without_a_phrase_are_not_cut(frame):
    text = "under the terms provided without any warranty license software permission granted "
    rows = [(1, text * 20_000), (2, text * 5_000 + TEMPLATES["zlib"] + text * 5_000)]
    found = {r.doc_id: [m.name for m in r.matches] for r in license_scan(frame(rows)).collect()}
    assert found == {1: [], 2: ["zlib"]}
