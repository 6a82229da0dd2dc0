"""Small tables with the awkward rows every operator must take."""

from fractions import Fraction

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns whose names clash with those the operators use inside or put out.
CLASHING = "_words _lines _marks _stop _once _n_upper _n_marks _n_lines n_words items spans ids decoded findings redacted _doc _text _key kept label high tags".split()


def documents(spark, rows):
    """Rows (doc_id, text) or longer as a documents table."""
    full = [(*row, "en", "src0", len(row[1] or ""))[:5] if len(row) == 2 else row for row in rows]
    return spark.createDataFrame(full, SCHEMA)


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.withColumns({name: F.lit(f"own {name}") for name in CLASHING})


def unharmed(df):
    """Whether the clashing columns still hold what they held."""
    return all(row[name] == f"own {name}" for row in df.select(*CLASHING).collect() for name in CLASHING)


def runs(text, n=5):
    words = text.lower().split() if text else []
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def jaccard_groups(texts):
    """Of {id: text}: class, number of links and group of every id, by comparing all pairs."""
    sets = {i: runs(t) for i, t in texts.items()}
    first = {}
    for i in sorted(sets):
        first.setdefault(sets[i], i)
    classes = {i: first[s] for i, s in sets.items()}
    own = sorted(set(classes.values()))
    links = {i: set() for i in own}
    for a in own:
        for b in own:
            x, y = sets[a], sets[b]
            if a < b and x and y and Fraction(len(x & y), len(x | y)) >= Fraction(4, 5):
                links[a].add(b)
                links[b].add(a)
    root = {i: i for i in own}
    changed = True
    while changed:
        changed = False
        for a in own:
            low = min([root[a], *(root[b] for b in links[a])])
            changed |= low != root[a]
            root[a] = low
    return {i: (c, len(links[c]), root[c]) for i, c in classes.items()}
