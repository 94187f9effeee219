"""Plain-Python forms of what the operators compute."""

import re

ODD_TEXTS = [None, "", " ", "\t\n \r", "one", "one two", "a b c", "A b  C\td", "x y z w v", "é É ñ ß 漢字 👍🏽", "...", "1234 5678",
             "same words here again", "Same\twords here again ", "w " * 5000, "<|endoftext|> inside", "l1\nl2\n\nl1\n"]


def odd_documents(spark, extra: str = ""):
    """Null ids, repeated rows, odd texts, and columns named like the operators' own."""
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 4 else None, len(t or "")) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[4], rows[4], (None, "no id", "en", "s1", 5), (None, None, None, None, None), (4, "other text of id four", "fr", "s0", 3)]
    names = ["digest", "keep_id", "kept", "a", "b", "token", "part", "tail", "_id", "score", "lead", "component", "text_sha256", "h"]
    fields = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame([(*r, *["clash"] * len(names)) for r in rows], fields)


def empty_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def words(text):
    return re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingle_set(text, width):
    w = words(text)
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}


def near_components(texts: dict, width: int, percent: int) -> dict:
    """Smallest id reachable by links of at least ``percent``, by comparing all pairs."""
    sets = {i: shingle_set(t, width) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}
