"""Main text of pages: layouts that must not lose it, ratios against a plain version, time."""

import collections
import math
import random
import re
import time

import pytest

from incident_engine.llm import html_main

BODY = "".join(f"<p>Sentence number {i}, with some words in it. And another one, longer than that.</p>" for i in range(6))
LINKS = "".join(f'<p><a href="x">Sentence {i} is linked, with many words in it, as above.</a></p>' for i in range(6))

PAGES = {
    "form around the body": (f'<body><form id="aspnetForm">{BODY}</form></body>', [], []),
    "form in main": (f"<main><form>{BODY}</form></main>", [], []),
    "form around an article": (f"<form><article>{BODY}</article></form>", [], []),
    "fieldset around": (f"<fieldset>{BODY}</fieldset>", [], []),
    "dialog around": (f'<div role="dialog">{BODY}</div>', [], []),
    "other attribute with hidden": (f'<div data-hidden="false">{BODY}</div>', [], []),
    "other attribute with role": (f'<div data-role="dialog">{BODY}</div>', [], []),
    "hidden in a value": (f'<div style="overflow: hidden ; x">{BODY}</div>', [], []),
    "hidden in a title": (f'<article>{BODY}<p title="the hidden side">Kept words stand here, in full.</p></article>', ["Kept"], []),
    "class in a value": (f"<article>{BODY}<p data-x='class=\"ad\" id=nav'>Kept words stand here, in full.</p></article>", ["Kept"], []),
    "hidden parts": (f'<article>{BODY}<p hidden>Gone one, for sure.</p><p aria-hidden = "TRUE">Gone two, for sure.</p><p HIDDEN="">Gone three.</p></article>', [], ["Gone"]),
    "closed svg": (f'<svg class="i"/>{BODY}', [], []),
    "nested svg": (f"<svg><svg><text>Gone</text></svg>Gone</svg>{BODY}", [], ["Gone"]),
    "formula": (f"<article>{BODY}<p>Then equals <math><mi>mass</mi><annotation>Gone</annotation></math> here.</p></article>", ["Then equals mass here."], ["Gone"]),
    "linked article": (f"<article>{LINKS}</article>", [], []),
    "title in a header": (f"<body><header><div><h1>The title</h1></div><p>Gone slogan</p></header><div>{BODY}</div></body>", ["The title"], ["Gone"]),
    "site name in a header": (f"<body><header><h1>Gone name</h1></header><h1>The title</h1><div>{BODY}</div></body>", ["The title"], ["Gone"]),
    "newsletter": (f"<article><h1>Top</h1>{BODY}<form><h3>Gone up</h3><p>Give us your address, Gone.</p></form></article>", ["Top"], ["Gone"]),
    "button": (f"<article>{BODY}<button>Gone</button></article>", [], ["Gone"]),
    "select": (f"<article>{BODY}<select><option>Gone</select></article>", [], ["Gone"]),
    "menu and footer": (f"<nav><a href=x>Gone</a></nav><article>{BODY}</article><footer>Gone, all of it.</footer>", [], ["Gone"]),
    "unclosed": (f"<div><article>{BODY}", [], []),
}


@pytest.mark.parametrize("name", PAGES)
def test_layouts_keep_the_article(name):
    page, there, gone = PAGES[name]
    text = html_main.main_text(page)
    assert text.count("Sentence") == 6
    assert all(w in text for w in there) and not any(w in text for w in gone)


def test_attributes():
    raw = """ a=1 B = 'x "y" hidden' c="d e=f" hidden data-role="g" a=2 h='' / """
    assert html_main.attributes_of(raw) == {"a": "1", "b": 'x "y" hidden', "c": "d e=f", "hidden": "", "data-role": "g", "h": ""}


def plain_blocks(tree, blocks):
    """(path of block elements, text, linked) with the path spelled out."""
    for b in blocks:
        path, e = [], b.node
        while e:
            path.append(tree.tag[e])
            e = tree.parent[e]
        yield tuple(t for t in reversed(path) if t in html_main.BLOCKS), b.text, b.linked


def test_ratios_equal_a_plain_version():
    rnd = random.Random(1)
    for _ in range(30):
        page = "".join(
            rnd.choice(["<div>", "</div>", "<p>", "<ul><li>", "</ul>", "<h2>", "</h2>", "<a href=x>", "</a>", "<section>", "</section>", "Some words, so. ", "more; "])
            for _ in range(200)
        )
        tree, blocks = html_main.blocks_of(page)
        none = [False] * len(tree.tag)
        paths = [tree.paths(none)[b.node] for b in blocks]
        plain = list(plain_blocks(tree, blocks))
        number = dict(zip(paths, (p for p, _, _ in plain)))
        assert len(set(paths)) == len({p for p, _, _ in plain}) and all(number[a] == p for a, (p, _, _) in zip(paths, plain))
        groups = collections.defaultdict(list)
        for p, text, linked in plain:
            groups[p].append((max(0, len(text) - linked), len(re.findall(r"[.,;:!?]", text))))
        if 10 * sum(min(len(t), x) for _, t, x in plain) >= 9 * sum(len(t) for _, t, _ in plain):
            continue
        score = html_main.path_scores(paths, blocks)
        for a, p in number.items():
            n = len(groups[p])
            want = sum(x for x, _ in groups[p]) / n * math.log2(2 + sum(m for _, m in groups[p]) / n)
            assert math.isclose(score[a], want)


def test_sums_and_ends_of_a_tree():
    tree, _ = html_main.blocks_of("<div><p>a<b>b</b></p><ul><li>c<li>d</ul></div><div>e</div>")
    inside = lambda e, of: e == of or e > of and inside(tree.parent[e], of)
    n = len(tree.tag)
    for of in range(n):
        assert tree.summed({e: 3**e for e in range(n)})[of] == sum(3**e for e in range(n) if inside(e, of))
        assert tree.ends()[of] == max(e for e in range(n) if inside(e, of))


@pytest.mark.parametrize("piece", ["<b>", "<div>x", "<li>y", "<div><p>z", "<a href='x'>t", '<div class="ad nav">w', '<a b="', "<ul><li>k", "<", "<svg>", "<!--", "<p title='"])
def test_time_is_in_proportion_to_the_page(piece):
    html_main.main_text(piece * 1000 + BODY)
    start = time.process_time()
    html_main.main_text(piece * 10_000 + BODY)
    small = time.process_time() - start
    start = time.process_time()
    html_main.main_text(piece * 80_000 + BODY)
    assert time.process_time() - start < 16 * small + 1
