"""Documents with nulls, empty and long texts, ties, repeated rows and clashing column names; brute-force helpers."""

import re

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, row long, digest string, kept boolean, node long, "
          "n long, spans string, bucket long, `group` long, label string, places string")

LONG = " ".join(f"w{i % 977}x{i * 7 % 1013}" for i in range(60_000))
PASSAGE = " ".join(f"passage{i}" for i in range(70))

ROWS = [
    (1, None, "en"), (2, "", "en"), (3, " \t\n ", None), (4, "one", "en"), (5, "One\x0btwo", "en"), (6, "one two three four", "fr"),
    (7, "one two three four", None), (7, "one two three four", None), (8, LONG, "en"), (9, LONG + " end", "en"),
    (10, "start here " + PASSAGE + " and some more words follow", "en"), (11, PASSAGE + " other end", "en"), (12, "x " + PASSAGE, "en"),
    (13, "12345 67890 !!", "en"), (14, "écoute l'été où il est né <|endoftext|> fin", "fr"), (15, "one two", "en"),
    (16, PASSAGE + " other end", "en"), (17, "naïve 你好 𝒳 text", "de"), (18, "w" * 20_000, "en"), (None, "no id here", "en"),
]


def odd(spark, rows=ROWS):
    full = [(i, t, lang, "s", len(t or ""), 1, "d", True, 2, 3, "s", 4, 5, "l", "p") for i, t, lang in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lowered(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def shingle_set(text, n):
    w = words(lowered(text))
    return {tuple(w[i: i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def component_ids(docs, n, percent):
    """Smallest reachable id of each (id, text) by comparing all pairs."""
    sets = [(i, shingle_set(t, n)) for i, t in docs]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in parent}
