"""Paragraphs of an article found by scores, for pages that do not mark it (M1).

One pass over a page's block tags keeps a stack of the open blocks. A paragraph
(``p``, ``pre``, ``td``) scores its stop words and a little for its length; one with half its text in
links scores nothing. Its score counts in full for the block that holds it and half for
the block around that. The best block is the article: its paragraphs that read as prose are kept, and what lies
between them; and so, step by step, is a paragraph at most ``NEIGHBOUR`` places from one that is kept if it holds the
end of a sentence or ``TEXT_WORDS`` words (a line of dialogue, a list of names). Prose as near, in a sister block, is kept too.

The scan is a small helper for each page; Spark hands it the pages that have no ``<article>``.
"""

from __future__ import annotations

import re
from html import unescape

# --- fixed values: blocks, and short words that prose of four languages is full of ----
BLOCKS = ("address article aside blockquote body center dd div dl dt fieldset figcaption figure footer form header h1 h2 h3 h4 h5 h6 "
          "hr li main nav ol p pre section table tbody td tfoot th thead tr ul").split()
PARAGRAPHS = frozenset(("p", "pre", "td"))
CONTROLS = frozenset(("aside", "footer", "form", "header", "nav"))      # never article text
STOPS = frozenset((
    "a an and are as at be but by for if in into is it no not of on or such that the their then there these they this to was will with "
    "au aux avec ce ces dans de des du elle en est et il la le les mais ne ou par pas pour que qui se son sur un une "
    "aber als am auf aus bei das dem den der die ein eine er es für im ist mit nicht sich sie so und von war wie zu "
    "al como con del el era ha las lo los más no para pero por se su una y").split())

NEIGHBOUR, PROSE_STOPS, TEXT_WORDS, LINK_SHARE, CHARS_PER_POINT = 3, 3, 10, 0.5, 100

_TAG = re.compile(r"<(/?)(" + "|".join(sorted(BLOCKS, key=len, reverse=True)) + r"|a)(?=[\s>/])[^<>]*>", re.I)
_SENTENCE = re.compile(r"[.!?…]")
_ANY, _WORD = re.compile(r"<[^<>]*>"), re.compile(r"[^\W\d_]+")


def _text(raw: str) -> str:
    return " ".join(unescape(_ANY.sub(" ", raw)).split())


class _Paragraph:
    __slots__ = ("raw", "parent", "grand", "stops", "score", "linked", "worded")

    def __init__(self, raw: str, link_raw: str, parent: int, grand: int):
        text = _text(raw)
        self.raw, self.parent, self.grand = raw, parent, grand
        words = _WORD.findall(text.lower())
        self.stops = sum(w in STOPS for w in words)
        self.worded = len(words) >= TEXT_WORDS or bool(_SENTENCE.search(text))
        self.linked = len(_text(link_raw)) >= LINK_SHARE * len(text)
        self.score = 0.0 if self.linked else self.stops + len(text) / CHARS_PER_POINT


def _paragraphs(html: str) -> list[_Paragraph]:
    """Paragraphs outside controls with the numbers of the blocks around them."""
    out: list[_Paragraph] = []
    stack: list[tuple[str, int]] = [("", 0)]      # open blocks: name, number
    open_of: dict[str, int] = {}                  # how many of each name are open
    made, controls = 0, 0
    start = link = None                           # of the open paragraph, of the link open in it
    links: list[str] = []

    def end(at: int) -> None:
        nonlocal start, link
        if start is not None:
            if link is not None:
                links.append(html[link:at])
            if not controls:
                # The paragraph is the top of the stack; its block is below it.
                grand = stack[-3][1] if len(stack) > 2 else 0
                out.append(_Paragraph(html[start:at], " ".join(links), stack[-2][1], grand))
        start = link = None
        links.clear()

    def pop() -> None:
        nonlocal controls
        name, _ = stack.pop()
        open_of[name] -= 1
        controls -= name in CONTROLS

    for m in _TAG.finditer(html):
        closing, name = m.group(1), m.group(2).lower()
        if name == "a":
            if start is not None and link is not None:
                links.append(html[link:m.start()])
            link = None if closing or start is None else m.end()
            continue
        if name == "hr":
            continue
        if closing:
            if open_of.get(name):
                while True:
                    if stack[-1][0] in PARAGRAPHS:
                        end(m.start())
                    last = stack[-1][0]
                    pop()
                    if last == name:
                        break
            continue
        if stack[-1][0] in ("p", "pre") or name == "td" and stack[-1][0] == "td":
            end(m.start())       # a block ends an open paragraph
            pop()
        elif stack[-1][0] == "td" and start is not None:
            end(m.start())       # text of a cell before a block in it
        made += 1
        stack.append((name, made))
        open_of[name] = open_of.get(name, 0) + 1
        controls += name in CONTROLS
        if name in PARAGRAPHS:
            start, link = m.end(), None
    if start is not None:
        end(len(html))
    return out


def scored_paragraphs(html: str | None) -> list[str]:
    """Raw HTML of the paragraphs of the page's article, in page order; none without a paragraph."""
    found = _paragraphs(html or "")
    score: dict[int, float] = {}
    for p in found:
        score[p.parent] = score.get(p.parent, 0) + p.score
        score[p.grand] = score.get(p.grand, 0) + p.score / 2
    score = {b: s for b, s in score.items() if s > 0}
    if not score:
        return []
    best = max(score, key=lambda b: (score[b], -b))
    beside = {p.grand for p in found if p.parent == best} - {0}
    kept = [False] * len(found)
    # Directly in the best block, or one level below it.
    inside = [(p.parent == best or p.grand == best) and not p.linked for p in found]
    prose = [i for i, p in enumerate(found) if inside[i] and p.stops >= PROSE_STOPS]
    if not prose:
        return [p.raw for i, p in enumerate(found) if inside[i] and p.worded]
    for i in range(prose[0], prose[-1] + 1):
        kept[i] = inside[i]
    for order in (range(len(found)), range(len(found) - 1, -1, -1)):
        last = None                        # the kept paragraph behind, in this direction
        for i in order:
            p = found[i]
            near = last is not None and abs(i - last) <= NEIGHBOUR
            if not kept[i] and near:
                kept[i] = p.worded if inside[i] else p.grand in beside and p.stops >= PROSE_STOPS and not p.linked
            if kept[i]:
                last = i
    return [p.raw for i, p in enumerate(found) if kept[i]]
