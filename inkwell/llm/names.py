"""Problem 7: spellings of one person, office or delegation linked.

Strings are counted once each, cut into title, given name and surname (or office, or the words of a delegation), and
folded to a key. Keys within two edits are found by a metric-space join (pivots, boundary copies by the triangle
inequality, an exact edit metric in each cell); of these a key joins its nearest and most frequent neighbour when one edit or
one exchange of neighbouring letters parts them, or two edits a long key from a much more frequent one, and neither title
nor given name speaks against it. Chains are closed by connected components. Below a surname, persons are told apart by
given name, initial and title: two of one surname with other given names or initials stay two.

Nulls and empty strings are left out. Strings without a letter are entities of their own. Repeated rows count once each.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.batches import map_columns
from inkwell.llm.components import connected_components, pointer_roots
from inkwell.llm.metric_join import radius_pairs
from inkwell.sources.shared import materialise

# Titles and their short forms, and the offices of a court.
TITLES = {
    "mr": "mr", "mister": "mr", "mrs": "mrs", "miss": "miss", "ms": "miss", "madame": "madame", "mme": "madame", "dr": "dr", "doctor": "dr",
    "prof": "professor", "professor": "professor", "col": "colonel", "colonel": "colonel", "gen": "general", "general": "general",
    "maj": "major", "major": "major", "capt": "captain", "captain": "captain", "lt": "lieutenant", "lieutenant": "lieutenant", "sir": "sir", "judge": "judge",
}
OFFICES = ("president", "marshal", "interpreter", "registrar", "stenographer", "secretary", "clerk", "bailiff", "usher", "prosecutor", "chairman", "translator", "reporter", "witness")
OCR = str.maketrans("01358", "oiesb")
_NOISE = re.compile(r"\((?:continuing|through [^)]*)\)|\[[^\]]*microphone[^\]]*\]|^\s*>+|SPEAKER \d+:|[\[(]?\b\d{1,2}[:.]\d\d(?::\d\d)?\b[\])]?")
#: The length from which a key may be two edits away, and how seldom such a key must then be against its hub.
LONG_KEY, SELDOM = 9, 0.2
_SMALL = {"of", "the", "and", "fo", "teh", "hte", "o", "th", "te", "for"}


def fold(text: str) -> str:
    """Lower case without marks over letters."""
    text = text.replace("Ø", "O").replace("ø", "o").replace("Ł", "L").replace("ł", "l").replace("ß", "ss")
    return "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c)).lower()


def one_edit(a: str, b: str) -> bool:
    """Whether at most one insertion, deletion, change, or exchange of neighbours parts the two."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    x, y = a[i:], b[i:]
    return x[1:] == y[1:] or x[1:] == y or x == y[1:] or (x[:2] == y[1::-1] and x[2:] == y[2:] and len(x) > 1 and len(y) > 1)


def _office(token: str, raw: str) -> str | None:
    for o in OFFICES:
        if token == o or (len(token) > 5 and one_edit(token, o)):
            return o
        if len(token) >= 3 and o.startswith(token) and re.search(rf"{token}\.", raw):
            return o
        if "'" in raw and len(token) >= 3 and o.startswith(token[:3]) and o[-1] == token[-1] and re.search(rf"{token[:-1]}['’]{token[-1]}", raw):
            return o
    return None


def parse(name: str) -> tuple[str, str, str, str, bool]:
    """Kind (person, office, org, acronym, other), key or first part, title, second part, whether the order is certain.

    A person's parts are (surname, given name) if a comma or an only name makes it certain, else in the order written.
    """
    bare = re.sub(r"[\[\]*>:(){}]", " ", _NOISE.sub(" ", name)).strip()
    bare = re.sub(r"(\.-+|\s-+)\s*$", "", bare)
    marked = re.match(r"Q\.\s+(?=\S+[ ,]+\S|\S+\.)", bare)
    if marked:
        bare = bare[marked.end() :]
    bare = re.sub(r"(?<=[a-z])(?=[A-Z])", " ", bare)
    low = fold(bare)
    initials = re.search(r"\b((?:[a-z]\.){2,})", low)
    tokens = re.findall(r"[^\W_]+(?:['’-][^\W_]+)*|,", low)
    words = [re.sub(r"['’-]", "", t) for t in tokens if t != ","]
    if not any(c.isalpha() for c in low):
        return "other", name, "", "", True
    is_org = any(one_edit(w, "delegation") or w == "deleg" for w in words)
    plain = [w.translate(OCR) for w in words if w not in _SMALL and not one_edit(w, "delegation") and w != "deleg"]
    if is_org and initials:
        return "acronym", initials.group(1).replace(".", ""), "", "", True
    office = next((o for w in plain if (o := _office(w, low))), None)
    if office and not is_org and (len(plain) == 1 or words[0] in _SMALL or plain[-1] in ("court", "tribunal") or plain[0] == "presiding"):
        return "office", office, "", "", True
    if is_org or (words and words[0] == "the" and len(plain) >= 2):
        return "org", "".join(plain), "", " ".join(plain), True
    title, rest, comma = "", [], -1
    for t in tokens:
        if t == ",":
            comma = len(rest) if comma < 0 else comma
        elif t in TITLES and not title:
            title = TITLES[t]
        else:
            rest.append(re.sub(r"['’-]", "", t).translate(OCR))
    if not rest:
        return "other", low, title, "", True
    if len(rest) == 1:
        return "person", rest[0], title, "", True
    if comma == 1:
        return "person", rest[0], title, rest[1], True
    if len(rest[0]) == 1:
        return "person", rest[-1], title, rest[0], True
    return "person", rest[-1], title, rest[0], bool(title)


def forms(strings: DataFrame, column: str) -> DataFrame:
    """Distinct strings with their number of rows and parts: name, n, kind, a, title, b, certain."""
    counted = strings.select(F.col(column).alias("name")).where("name is not null and name != ''").groupBy("name").agg(F.count(F.lit(1)).alias("n"))

    def kernel(c: dict, _) -> dict:
        kind, a, title, b, certain = zip(*(parse(x) for x in c["name"])) if c["name"] else ((),) * 5
        return {"name": c["name"], "n": c["n"], "kind": kind, "a": a, "title": title, "b": b, "certain": certain}

    return map_columns(counted, kernel, "name string, n bigint, kind string, a string, title string, b string, certain boolean")


def _near(x: Column, y: Column) -> Column:
    """One edit or one exchange of neighbours, for strings known to be within two edits."""
    at = F.length(F.regexp_extract(F.concat(x, F.lit("\n"), y), r"^(.*).*\n\1", 1))
    swapped = (F.length(x) == F.length(y)) & (F.substr(x, at + 1, F.lit(2)) == F.reverse(F.substr(y, at + 1, F.lit(2)))) & (F.substr(x, at + 3) == F.substr(y, at + 3))
    return (F.levenshtein(x, y) <= 1) | swapped


def _oriented(f: DataFrame) -> DataFrame:
    """Two-part names without a comma or title put in order: a given name goes with many surnames, a surname stands alone."""
    persons = f.where("kind = 'person'")
    alone = persons.where("certain").groupBy(F.col("a").alias("w")).agg(F.lit(1).alias("alone"))
    pairs = persons.where("b != '' and length(b) > 1").select("a", "b").distinct()
    partners = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy(F.col("a").alias("w")).agg(F.count_distinct("b").alias("partners"))
    facts = partners.join(alone, "w", "full")
    known = lambda s: facts.select(F.col("w").alias(s), F.coalesce("alone", F.lit(0)).alias(f"alone_{s}"), F.coalesce("partners", F.lit(0)).alias(f"many_{s}"))
    joined = f.join(known("a"), "a", "left").join(known("b"), "b", "left")
    loose = (F.col("kind") == "person") & ~F.col("certain") & (F.length("b") > 1)
    swap = loose & (
        ((F.col("alone_b") == 1) & (F.col("alone_a") == 0))
        | ((F.col("alone_a") == F.col("alone_b")) & (F.col("many_a") > 2 * F.col("many_b")) & (F.col("many_a") > 2))
    )
    return joined.select(
        "name", "n", "kind", "title", F.when(swap, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(swap, F.col("a")).otherwise(F.col("b")).alias("b")
    )


def _nick(short: Column, full: Column) -> Column:
    """Whether ``short`` may stand for the given name ``full``: its beginning, or that with -y or -ie."""
    stem = F.regexp_replace(short, "(?:ie|ey|y)$", "")
    return (F.length(full) > F.length(short)) & ((F.length(short) >= 3) & F.startswith(full, short) | (F.length(stem) >= 2) & (F.length(stem) < F.length(short)) & F.startswith(full, stem))


def _shortened(c: Column) -> Column:
    """A string and what is left of it without one letter: two strings share one if one edit or one exchange parts them."""
    at = F.sequence(F.lit(1), F.length(c))
    return F.array_distinct(F.concat(F.array(c), F.transform(at, lambda i: F.concat(F.left(c, i - 1), F.substr(c, i + 1)))))


def entities(strings: DataFrame, column: str) -> DataFrame:
    """Each distinct string with its entity: name, entity."""
    f = materialise(_oriented(forms(strings, column)))
    # 1. keys of one kind, and the more frequent key that each is a misspelling of
    keys = f.where("kind in ('person', 'org', 'office')").groupBy("kind", "a").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("forms"), F.collect_set(F.when(F.col("title") != "", F.col("title"))).alias("titles"),
        F.collect_set(F.when(F.length("b") > 2, F.substring("b", 1, 2))).alias("givens"),
    ).withColumn("key", F.concat(F.substring("kind", 1, 2), F.col("a")))
    keys = materialise(keys)
    x, y = F.col("x"), F.col("y")
    close = radius_pairs(keys, "key", 2, weight="n").withColumn("one", _near(x, y))
    close = close.where(F.col("one") | (F.least(F.length(x), F.length(y)) >= LONG_KEY))
    both = close.select(x.alias("key"), y.alias("hub"), "one").unionByName(close.select(y.alias("key"), x.alias("hub"), "one"))
    hub = keys.select(F.col("key").alias("hub"), F.col("n").alias("hub_n"), F.col("titles").alias("hub_titles"), F.col("givens").alias("hub_givens"))
    against = lambda mine, theirs: (F.size(mine) > 0) & (F.size(theirs) > 0) & ~F.arrays_overlap(mine, theirs)
    bigger = (F.col("hub_n") > F.col("n")) | ((F.col("hub_n") == F.col("n")) & (F.col("hub") < F.col("key")))
    # a short name is near many others: it needs a title or given name in common
    agree = F.arrays_overlap("titles", "hub_titles") | F.arrays_overlap("givens", "hub_givens")
    fits = both.join(keys, "key").join(hub, "hub").where(
        bigger & ((F.length("key") > 5) | agree) & ~against(F.col("titles"), F.col("hub_titles"))
        & (~against(F.col("givens"), F.col("hub_givens")) | (F.col("kind") == "org"))
        & ((F.col("n") <= 0.5 * F.col("hub_n")) | (F.col("forms") <= 2)) & (F.col("one") | (F.col("n") <= SELDOM * F.col("hub_n")))
    )
    to = fits.groupBy("key").agg(F.max_by("hub", F.struct("one", "hub_n", "hub")).alias("hub"))
    # pointers are followed to their end, however long the chain
    roots = pointer_roots(to.select(F.col("key").alias("node"), F.col("hub").alias("to"))).select(F.col("node").alias("key"), F.col("root").alias("top"))
    rooted = f.withColumn("key", F.concat(F.substring("kind", 1, 2), F.col("a"))).join(roots, "key", "left").withColumn("root", F.coalesce("top", "key"))
    rooted = materialise(rooted.select("name", "n", "kind", "a", "title", "b", "root"))
    # 2. delegations by their initials
    orgs = rooted.where("kind = 'org' and b != ''").select(
        F.array_join(F.transform(F.split("b", " "), lambda w: F.substring(w, 1, 1)), "").alias("a"), "root", "n"
    ).groupBy("a").agg(F.max_by("root", F.struct("n", "root")).alias("org"))
    plain = rooted.where("kind != 'person'").join(orgs, "a", "left")
    others = plain.select("name", F.when(F.col("kind") == "acronym", F.coalesce("org", "root")).otherwise(F.col("root")).alias("entity"))
    # 3. persons below a surname: given names that stand for a fuller or more frequent one
    p = rooted.where("kind = 'person'").select("name", "n", "title", "root", F.col("b").alias("given"))
    g = p.where("length(given) > 1").groupBy("root", "given").agg(F.sum("n").alias("n"))
    g = materialise(g)
    full = g.select("root", F.col("given").alias("to"), F.col("n").alias("to_n"))
    # pairs meet on a beginning or a shortened form, never all with all
    stem = F.regexp_replace("given", "(?:ie|ey|y)$", "")
    beginnings = F.transform(F.sequence(F.lit(2), F.greatest(F.lit(2), F.length("to") - 1)), lambda k: F.left("to", k))
    nicks = g.select("*", F.explode(F.array_distinct(F.array("given", stem))).alias("meet")).join(full.select("*", F.explode(beginnings).alias("meet")), ["root", "meet"])
    nicks = nicks.where((F.col("given") != F.col("to")) & _nick(F.col("given"), F.col("to")))
    more = (F.col("to_n") > F.col("n")) | ((F.col("to_n") == F.col("n")) & (F.col("to") < F.col("given")))
    near = g.where("length(given) > 3").select("*", F.explode(_shortened(F.col("given"))).alias("meet")).join(full.select("*", F.explode(_shortened(F.col("to"))).alias("meet")), ["root", "meet"])
    near = near.where((F.col("given") != F.col("to")) & more & _near(F.col("given"), F.col("to")) & (F.levenshtein("given", "to") <= 2))
    best = nicks.select("root", "given", "to", "to_n").unionByName(near.select("root", "given", "to", "to_n")).groupBy("root", "given").agg(F.max_by("to", F.struct("to_n", "to")).alias("to"))
    node = lambda c: F.concat("root", F.lit("\t"), c)
    tops = connected_components(best.select(node(F.col("given")).alias("a"), node(F.col("to")).alias("b"))).select(
        F.substring_index("node", "\t", 1).alias("root"), F.substring_index("node", "\t", -1).alias("given"), F.col("root").alias("top")
    )
    # a component is named by its most frequent given name
    grouped = g.join(tops, ["root", "given"], "left").withColumn("top", F.coalesce("top", node(F.col("given"))))
    called = grouped.groupBy("root", "top").agg(F.max_by("given", F.struct("n", "given")).alias("person"))
    whose = materialise(grouped.join(called, ["root", "top"]).select("root", "given", "person"))
    named = materialise(p.join(whose, ["root", "given"], "left"))
    # 4. initials and lone surnames: what each may stand for is counted, so that no surname is gathered in one place
    persons = named.where("person is not null").groupBy("root", "person").agg(F.collect_set(F.when(F.col("title") != "", F.col("title"))).alias("titles"))
    by_root = persons.groupBy("root").agg(F.count(F.lit(1)).alias("n_persons"), F.min("person").alias("lone"), F.min_by("titles", "person").alias("lone_titles"))
    by_letter = persons.groupBy("root", F.left("person", F.lit(1)).alias("given")).agg(F.count(F.lit(1)).alias("n_starts"), F.min("person").alias("starts"))
    by_title = persons.select("root", "person", F.explode("titles").alias("title")).groupBy("root", "title").agg(F.count(F.lit(1)).alias("n_titled"), F.min("person").alias("titled"))
    letters = named.where("length(given) = 1 and given != 'q'").groupBy("root").agg(F.count_distinct("given").alias("n_letters"))
    at = named.join(by_root, "root", "left").join(by_letter, ["root", "given"], "left").join(by_title, ["root", "title"], "left").join(letters, "root", "left")
    at = at.withColumns({"n_persons": F.coalesce("n_persons", F.lit(0)), "n_letters": F.coalesce("n_letters", F.lit(0))})
    free = (F.col("title") == "") | (F.size("lone_titles") == 0) | F.array_contains("lone_titles", F.col("title"))
    lone = F.when(F.col("n_persons") == 1, F.col("lone"))
    by_given = F.when(
        F.length("given") == 1,
        F.coalesce(F.when(F.col("n_starts") == 1, F.col("starts")), F.when((F.col("given") == "q") | (F.col("n_persons") == 0), F.lit("")), F.col("given")),
    )
    by_title = F.coalesce(F.when(free, lone), F.when(F.col("n_titled") == 1, F.col("titled")))
    settled = at.withColumn("who", F.when(F.col("given") == "", by_title).otherwise(F.coalesce(F.col("person"), by_given)))
    settled = settled.withColumn("who", F.when((F.col("who") == "") & (F.col("n_persons") == 1), F.col("lone")).otherwise(F.col("who")))
    unknown = F.when(F.col("n_persons") == 0, F.lit("")).otherwise(F.concat(F.lit("?"), F.col("title")))
    guess = F.when((F.col("n_persons") == 0) & (F.col("n_letters") <= 1), F.lit("")).otherwise(F.coalesce("who", unknown))
    return others.unionByName(settled.select("name", F.concat_ws("/", "root", guess).alias("entity")))


def variant_pairs(linked: DataFrame) -> DataFrame:
    """All pairs of different strings of one entity: name_a < name_b by code points."""
    a = linked.select("entity", F.col("name").alias("name_a"))
    b = linked.select("entity", F.col("name").alias("name_b"))
    return a.join(b, "entity").where("name_a < name_b").select("name_a", "name_b")
