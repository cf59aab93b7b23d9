"""Small tables with awkward rows, and brute-force versions of the contracts."""

from __future__ import annotations

import hashlib
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, kept string, digest string, node string, mark long"
LONG = " ".join(f"w{i % 977}x{i // 977}" for i in range(6000))
BASE = " ".join(f"t{i}" for i in range(120))
NEAR = BASE.replace("t60 ", "u60 ")
#: Null and empty texts, white space only, copies that differ in spaces, near copies, repeated rows, a null id, long words and texts, marks.
ROWS = [
    (1, BASE, "en", "b"), (2, NEAR, "en", "b"), (3, BASE.replace(" ", "\t\n"), "en", "a"), (3, BASE.replace(" ", "\t\n"), "en", "a"),
    (4, None, "en", "a"), (5, "", None, None), (6, " \t\n ", "fr", "a"), (7, LONG, "fr", "c"), (8, LONG + " end", "fr", "c"),
    (9, "short one", "en", "a"), (10, "short one", "en", "a"), (11, "a\x85b É é A a\x0bb\x0cc", "de", "z"), (None, "no id here", "en", None),
    (12, "the same line\nthe same line\nthe same line\n" * 12, "en", "a"), (13, "x " * 300, "en", "a"), (14, "q" * 5000, "en", "\U0001f600"),
    (15, "# * $ % & | < > " * 20, "en", "￿"), (16, "Released under CC BY and the GNU General Public License. All rights reserved", None, "b"),
    (17, "intro " + BASE + " outro", "en", "b"), (12, "other text under a known id " * 5, "en", "a"),
]


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(*row, None, "clash", "clash", None, "clash", 7) for row in rows], SCHEMA)


def spaced(text):
    return re.sub(r"[\x20\x09-\x0d]+", " ", text or "")


def words(text):
    return (text or "").encode().split()


def shingle_sets(rows):
    lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    for _, text, *_ in rows:
        w = words((text or "").encode().translate(lower).decode())
        yield {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def near_components(rows):
    """Per row: size of its set and the smallest id in reach."""
    sets = list(shingle_sets(rows))
    group = list(range(len(rows)))
    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    lowest = {g: min((rows[i][0] for i in range(len(rows)) if group[i] == g and rows[i][0] is not None), default=None) for g in group}
    return [(rows[i][0], len(sets[i]), lowest[group[i]] if sets[i] else rows[i][0]) for i in range(len(rows))]


def removed_windows(rows, width=20):
    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    seen, found = set(), {}
    for row in order:
        w = words(row[1])
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            key = tuple(w[i : i + width])
            if key in seen:
                gone[i : i + width] = [True] * width
            seen.add(key)
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        found[row] = (row[0], len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    return [found[row] for row in rows]


def in_order(rows):
    return sorted(rows, key=repr)
