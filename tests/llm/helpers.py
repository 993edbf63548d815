"""Documents with awkward rows, and plain versions of common steps."""

import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, __text string, key string, id int"
SPACES = "[\x20\x09-\x0d]+"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text):
    return [w for w in re.split(SPACES, text or "") if w]


def awkward(extra=()):
    """Null, empty and blank texts, a null id, repeated rows, a null source, and one long text; extra (id, text) pairs."""
    long_text = " ".join(f"Wort{i % 977} é{i % 13} x{i % 7}" for i in range(12_000))
    rows = [(1, None, "s0"), (2, "", "s0"), (3, " \n\t ", "s1"), (None, "a null id has these words", "s1"), (5, "same row", None), (5, "same row", None), (6, long_text, "s0"), (7, "one", "s2"), (8, "\x0b\x1c odd\x85space\u2003here \u0130 ß", "s2")]
    rows += [(i, t, "s0") for i, t in extra]
    return [(i, t, "en", s, len(t or ""), "clash", "clash", 0) for i, t, s in rows]


def sf_rows(spark, limit=None, sf="/root/testdata/sf0.001"):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    return sorted(rows)[:limit]


def frame(spark, extra=()):
    return spark.createDataFrame(awkward(extra), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def chains(n, pairs):
    """The least of what each of 0..n-1 hangs together with by the pairs."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in pairs:
        a, b = find(int(a)), find(int(b))
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def similar_pairs(texts):
    """All pairs of texts with a similarity of 0.8 or more, through lists of the texts that have each shingle."""
    sets = [{hash(tuple(w[i : i + 5])) for i in range(max(1, len(w) - 4))} if w else set() for w in (words(lower(t)) for t in texts)]
    having = {}
    for k, own in enumerate(sets):
        for x in own:
            having.setdefault(x, []).append(k)
    shared = {}
    for own in having.values():
        for i, a in enumerate(own):
            for b in own[i + 1 :]:
                shared[a, b] = shared.get((a, b), 0) + 1
    return [(a, b) for (a, b), n in shared.items() if 10 * n >= 8 * (len(sets[a]) + len(sets[b]) - n)]


def believed_patterns(occurrences):
    """kind of each pattern that three rounds of belief end with, from (pattern, instance, seed) of all occurrences."""
    pairs = {}
    for p, i, seed in occurrences:
        pairs[p, i] = max(seed, pairs.get((p, i), ""))
    size, kind = {}, {}
    for (p, _), seed in pairs.items():
        size[p] = size.get(p, 0) + 1
        kind[p] = max(seed, kind.get(p, ""))
    pairs = {k: v for k, v in pairs.items() if size[k[0]] >= 3}
    belief = {}
    for (_, i), seed in pairs.items():
        belief[i] = max(float(seed != ""), belief.get(i, 0.0))
    for last in (False, False, True):
        conf = {}
        for p, i in pairs:
            conf[p] = conf.get(p, 0.0) + belief[i] / size[p]
        if not last:
            doubt = {}
            for (p, i), seed in pairs.items():
                own = 1.0 if seed else conf[p] if conf[p] >= 0.6 - 1e-12 else 0.0
                doubt[i] = doubt.get(i, 1.0) * max(1 - own, 1e-6)
            belief = {i: 1 - x for i, x in doubt.items()}
    return {p: kind[p] for p, c in conf.items() if c >= 0.6 - 1e-9 and kind[p]} if pairs else {}
