"""Secret scans behind a trigram index.

From each rule's pattern a Boolean query over trigrams is derived: any text
that matches contains all trigrams of one of its alternatives. Postings from
these trigrams to the texts that contain them are written as a table. Their
intersections give, per rule, the texts worth a look, and only there the
pattern runs. Patterns without a mandatory trigram run on every text.
Everything is DataFrame and SQL functions.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airq.llm.common import fresh
from airq.sources.staging import stage

MASK = "[SECRET]"
#: More strings than this are not spelled out when a query is derived.
SPELLED = 64
#: Rows of one text are joined with its candidates in so many parts.
PARTS = 8


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` whose ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The first three are runs of a character class after a fixed beginning, or nothing but a run. Such a
#: run is as long as it can be, so a shorter one hides no longer one, and the least length may stand in the pattern.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
_BEGIN, _END = (rf"-----{word} [A-Z ]{{0,40}}PRIVATE KEY(?: BLOCK)?-----" for word in ("BEGIN", "END"))
_LINE, _GAP = "[A-Za-z0-9+/]{16,}={0,2}", "[^A-Za-z0-9+/=-]"
#: From its first line to the END line, whatever stands between but five hyphens. Without an END line over the lines with a
#: name and a colon, then to the last base64 character: any number of long lines and a short one, which is padded or fills
#: its line. Each loop can be passed through in one way only, so it never gives back what it took (``*+``), which keeps
#: Java's stack flat; an engine without ``*+`` finds the same with ``*``.
PEM = (
    rf"{_BEGIN}(?:[^-]*+(?:-{{1,4}}[^-]+)*+{_END}|"
    rf"(?:(?:[\x20\x09\x0D]*\n(?:[A-Za-z0-9-]{{1,15}}:[^\n]*\n)*+)?{_GAP}{{0,8}}{_LINE}(?:{_GAP}{{1,8}}{_LINE})*+"
    rf"(?:{_GAP}{{1,8}}[A-Za-z0-9+/]{{1,15}}={{1,2}}|[\x20\x09\x0D]*\n[\x20\x09]*[A-Za-z0-9+/]{{1,15}}(?m:$))?)?)"
)
RULES = (*BASE, Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"), Rule("pem", PEM))

Query = frozenset  # alternatives, each a frozenset of trigrams that must all be there
ANY: Query = frozenset([frozenset()])


def trigrams(strings: frozenset[str]) -> Query:
    """What must be there if one of the strings is."""
    if any(len(s) < 3 for s in strings):
        return ANY
    return shortest(frozenset(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings))


def shortest(query: Query) -> Query:
    """Without alternatives that ask for more than another one."""
    return frozenset(a for a in query if not any(b < a for b in query))


def both(a: Query, b: Query) -> Query:
    if len(a) * len(b) > SPELLED:
        return max(a, b, key=lambda q: min(map(len, q)))
    return shortest(frozenset(x | y for x, y in product(a, b)))


class Reader:
    """Reads the patterns of rules into nodes: ("set", characters or None if many), ("cat", nodes), ("alt", nodes), ("rep", node, least, most).

    It knows literals, classes, groups with or without flags, alternatives, repeats and ends of lines; letters
    are lowered, as the texts are. Other signs after a backslash or ``(?`` raise ValueError.
    """

    def __init__(self, pattern: str):
        self.pattern, self.at = pattern, 0

    def next(self, wanted: str = "") -> str:
        """The next sign, taken if it is among the wanted ones (any, if none are named)."""
        c = self.pattern[self.at : self.at + 1]
        if not c or (wanted and c not in wanted):
            return ""
        self.at += 1
        return c

    def whole(self):
        node = self.alternatives()
        if self.at < len(self.pattern):
            raise ValueError(f"unread at {self.at}: {self.pattern}")
        return node

    def alternatives(self):
        found = [self.sequence()]
        while self.next("|"):
            found.append(self.sequence())
        return found[0] if len(found) == 1 else ("alt", found)

    def sequence(self):
        found = []
        while self.pattern[self.at : self.at + 1] not in ("", "|", ")"):
            found.append(self.repeated(self.single()))
        return ("cat", found)

    def single(self):
        c = self.next()
        if c == "(":
            if self.next("?"):
                while (flag := self.next()) != ":":
                    if flag not in ("i", "m"):
                        raise ValueError(f"unknown group at {self.at}: {self.pattern}")
            node = self.alternatives()
            if not self.next(")"):
                raise ValueError(f"group without end: {self.pattern}")
            return node
        if c == "[":
            return ("set", self.characters())
        if c in "^$":
            return ("cat", [])
        if c == ".":
            return ("set", None)
        return ("set", {(self.escaped() if c == "\\" else c).lower()})

    def escaped(self) -> str:
        c = self.next()
        if c == "x":
            self.at += 2
            return chr(int(self.pattern[self.at - 2 : self.at], 16))
        if c in ("n", "r", "t"):
            return {"n": "\n", "r": "\r", "t": "\t"}[c]
        if not c or c.isalnum():
            raise ValueError(f"unknown sign at {self.at}: {self.pattern}")
        return c

    def characters(self):
        out, found, many = bool(self.next("^")), set(), False
        first = True
        while first or self.pattern[self.at : self.at + 1] != "]":
            first = False
            c = self.next()
            if not c:
                raise ValueError(f"class without end: {self.pattern}")
            c = self.escaped() if c == "\\" else c
            end = c
            if self.pattern[self.at : self.at + 1] == "-" and self.pattern[self.at + 1 : self.at + 2] not in ("]", ""):
                self.at += 1
                end = self.next()
                end = self.escaped() if end == "\\" else end
            many |= ord(end) - ord(c) >= SPELLED
            found |= {chr(x).lower() for x in range(ord(c), min(ord(end), ord(c) + SPELLED) + 1)}
        self.at += 1
        return None if out or many or len(found) > 8 else found

    def repeated(self, node):
        while c := self.next("?*+{"):
            least, most = {"?": (0, 1), "*": (0, None), "+": (1, None)}.get(c, (0, None))
            if c == "{":
                to = self.pattern.index("}", self.at)
                a, comma, b = self.pattern[self.at : to].partition(",")
                least, most = int(a), (int(b) if b else None) if comma else int(a)
                self.at = to + 1
            self.next("?+")  # whether it gives back does not change what is mandatory
            node = ("rep", node, least, most)
        return node


def spelled(node) -> frozenset[str] | None:
    """All strings, in lower case, that a node matches, if they are few."""
    kind, value = node[0], node[1]
    if kind == "set":
        return None if value is None else frozenset(value)
    if kind == "alt":
        branches = [spelled(b) for b in value]
        found = None if None in branches else frozenset().union(*branches)
        return found if found is not None and len(found) <= SPELLED else None
    if kind == "rep":
        _, one, least, most = node
        one = spelled(one) if most is not None and most <= 8 else None
        if one is None or len(one) ** most > SPELLED:
            return None
        return frozenset("".join(p) for k in range(least, most + 1) for p in product(one, repeat=k))
    found = frozenset([""])
    for part in value:
        strings = spelled(part)
        if strings is None or len(found) * len(strings) > SPELLED:
            return None
        found = frozenset(a + b for a, b in product(found, strings))
    return found


def required(pattern: str) -> Query:
    """The Boolean trigram query of a pattern: any lowered text that matches satisfies one alternative."""
    return of_node(Reader(pattern).whole())


def of_node(node) -> Query:
    if node[0] == "alt":
        return shortest(frozenset().union(*map(of_node, node[1])))
    if node[0] == "rep":
        return of_node(node[1]) if node[2] >= 1 else ANY
    query, run = ANY, frozenset([""])
    for part in node[1] if node[0] == "cat" else [node]:
        strings = spelled(part)
        if strings is not None and len(run) * len(strings) <= SPELLED:
            run = frozenset(a + b for a, b in product(run, strings))
            continue
        query, run = both(query, trigrams(run)), strings if strings is not None else frozenset([""])
        if strings is None and part[0] != "set":
            query = both(query, of_node(part))
    return both(query, trigrams(run))


def text_keys() -> list[Column]:
    """128 bits that stand for a text; a null text counts as empty."""
    text = F.coalesce("text", F.lit(""))
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("second"), text).alias("k2")]


def index(docs: DataFrame, wanted: list[str]) -> DataFrame:
    """Postings (trigram, k1, k2) of the wanted trigrams in the lowered texts, as a written table."""
    low = docs.select(*text_keys(), F.lower("text").alias("low"))
    there = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in wanted]))
    return stage(low.select(F.explode(there).alias("trigram"), "k1", "k2"), "postings")


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(k1, k2, rules): by text, the numbers of the rules whose trigram query it satisfies."""
    queries = [required(r.pattern) for r in rules]
    wanted = sorted({t for q in queries for alternative in q for t in alternative})
    if not wanted:
        none = docs.select(*text_keys(), F.array().cast("array<int>").alias("rules"))
        return none.where(F.lit(False))
    held = index(docs, wanted).groupBy("k1", "k2").agg(F.collect_set("trigram").alias("held"))

    def satisfied(query: Query) -> Column:
        found = F.lit(False)
        for alternative in sorted(query, key=sorted):
            found = found | (F.size(F.array_intersect("held", F.array(*map(F.lit, sorted(alternative))))) == len(alternative))
        return found

    numbers = F.array_compact(F.array(*[F.when(satisfied(q), F.lit(i)) for i, q in enumerate(queries) if q != ANY]))
    return held.select("k1", "k2", numbers.alias("rules")).where(F.size("rules") > 0)


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def spans_of(number: int, rule: Rule) -> str:
    """SQL for the spans of one rule in ``text``: starts add up the lengths of the matches and of what lies between them."""
    p, kind = quoted(rule.pattern), "array<struct<start:int,kind:int,end:int>>"
    return f"""aggregate(
      arrays_zip(slice(split(text, {p}, -1), 1, size(regexp_extract_all(text, {p}, 0))), regexp_extract_all(text, {p}, 0), regexp_extract_all(text, {p}, {rule.group})),
      named_struct('at', 0, 'found', CAST(array() AS {kind})),
      (acc, x) -> named_struct('at', acc.at + char_length(x['0']) + char_length(x['1']), 'found', CAST(IF(char_length(x['2']) >= {rule.least},
        concat(acc.found, array(named_struct('start', acc.at + char_length(x['0']), 'kind', {number}, 'end', acc.at + char_length(x['0']) + char_length(x['1'])))),
        acc.found) AS {kind})),
      acc -> acc.found)"""


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` (with a column ``text``) and ``found``: array of (start, kind, end) by start, then rule.

    ``kind`` is the rule's number; positions are code points, ends exclusive. Matches of one rule
    are leftmost and do not overlap; those of different rules may. Null and empty texts have no spans.
    """
    looked = candidates(docs, rules).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    others = [c for c in docs.columns if c != "text"]
    row = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)])
    packed = docs.select(row.alias("row"), "text", *text_keys(), F.pmod(F.xxhash64(row), F.lit(PARTS)).cast("int").alias("part"))
    joined = packed.join(looked, ["k1", "k2", "part"], "left").select("row", "text", "rules")
    each = []
    for i, rule in enumerate(rules):
        look = F.expr(f"text RLIKE {quoted(rule.pattern)}")
        if required(rule.pattern) != ANY:
            look = F.array_contains("rules", i) & look
        each.append(F.when(look, F.expr(spans_of(i, rule))).otherwise(F.expr("CAST(array() AS array<struct<start:int,kind:int,end:int>>)")))
    found = joined.select("row", "text", F.array_sort(F.flatten(F.array(*each))).alias("found"))
    place = {c: i for i, c in enumerate(others)}
    return found.select(*[F.col("text") if c == "text" else F.col("row")[f"c{place[c]}"].alias(c) for c in docs.columns], "found")


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Stage: every span is replaced by ``[SECRET]``, overlapping ones by one; ``n_chars`` follows if it is there.

    All rows stay, null texts too; texts without spans do not change.
    """
    columns = docs.columns
    marked = docs.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns) if c != "text"]).alias("row_"), "text")
    own = {c: F.col("row_")[f"c{i}"] for i, c in enumerate(columns) if c != "text"}
    masked = F.expr(f"""aggregate(found, named_struct('at', 0, 'out', ''), (acc, x) -> IF(x.start < acc.at AND acc.at > 0,
      named_struct('at', greatest(acc.at, x.end), 'out', acc.out),
      named_struct('at', x.end, 'out', concat(acc.out, substring(text, acc.at + 1, x.start - acc.at), '{MASK}'))),
      acc -> concat(acc.out, substring(text, acc.at + 1)))""")
    out = scan(marked, rules).withColumn("masked", F.when(F.size("found") > 0, masked).otherwise(F.col("text")))
    new = {"text": F.col("masked"), "n_chars": F.when(F.size("found") > 0, F.char_length("masked").cast(dict(docs.dtypes).get("n_chars", "long"))).otherwise(own.get("n_chars"))}
    return out.select(*[(new[c] if c in new else own[c]).alias(c) for c in columns])


def joined(found: str, where: str = "true") -> Column:
    names = ", ".join(quoted(r.kind) for r in RULES)
    return F.expr(f"array_join(transform(filter({found}, x -> {where}), x -> concat(element_at(array({names}), x.kind + 1), ':', x.start, ':', x.end)), ',')")


def query(spark, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    count = lambda i: F.size(F.filter("found", lambda x: x["kind"] == i)).cast("long")
    return found.select(
        "doc_id", *[count(i).alias(f"n_{r.kind}") for i, r in enumerate(BASE)],
        F.sha2(joined("found", f"x.kind < {len(BASE)}"), 256).alias("base_sha256"), joined("found").alias("spans"),
    )


def _sql() -> str:
    parts = []
    for i, r in enumerate(RULES):
        p = "'" + r.pattern.replace("'", "''").replace("*+", "*") + "'"
        parts.append(f"""SELECT doc_id, text, {i} AS k, '{r.kind}' AS kind, regexp_split_to_array(text, {p}) AS g, regexp_extract_all(text, {p}) AS m,
      regexp_extract_all(text, {p}, {r.group}) AS v, {r.least} AS least FROM documents WHERE regexp_matches(text, {p})""")
    return f"""
WITH a AS ({" UNION ALL ".join(parts)}),
b AS (SELECT doc_id, k, kind, g, m, v, least, unnest(range(1, len(m) + 1)) AS i FROM a),
c AS (SELECT doc_id, k, kind, length(v[i]) >= least AS ok,
  list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS s, length(m[i]) AS n FROM b),
d AS (SELECT doc_id, k, s, kind || ':' || s::BIGINT || ':' || (s + n)::BIGINT AS t FROM c WHERE ok),
e AS (SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
  string_agg(t, ',' ORDER BY s, k) FILTER (k < {len(BASE)}) AS base, string_agg(t, ',' ORDER BY s, k) AS spans FROM d GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM documents LEFT JOIN e USING (doc_id)
"""


SQL = _sql()
