"""Secrets in texts: candidates by pattern, false positives removed by a random forest. DataFrame operations only.

A candidate is a run of key characters with a digit in it, or any value of 8 characters or more that is assigned to a secret's name
or follows ``Bearer``; names and ``=`` in front are no part of it. What is known about it becomes a struct of numbers: length, character
classes and how often they change, share of letters that dictionary words cover, words next to it, and the path of the text. A
random forest (Spark ML) is trained on labelled findings; its trees are then written out as one SQL expression, so scoring and
redaction happen inside the row that holds the text and nothing is shuffled.
"""

from __future__ import annotations

import string
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultflow.session import stage

#: Shortest candidate.
SHORTEST = 16
#: Labelled findings used at most, half of them of either label, those with the smallest hash; all documents are looked through for them.
TRAIN_ROWS = 20_000
#: Most frequent words kept as the dictionary.
DICTIONARY = 400
#: Made-up keys, and as many made-up numbers, that every training set from a table with rows holds (an eighth of its bound, if that is less).
MADE = 64
THRESHOLD = 0.5
REDACTED = "[SECRET]"
#: A pattern that matches nothing.
NO_WORD = "(?!)"

# What names a secret, what names something that only looks like one, and paths of both kinds.
SECRET_NAMES = "token|secret|passw|pwd|api.?key|access.?key|private.?key|auth|credential|bearer"
OTHER_NAMES = "sha.?1|sha.?256|sha.?512|md5|commit|checksum|digest|hash|uuid|guid|etag|integrity|revision|order|invoice|phone|card"
EXAMPLE_PATHS = "test|example|sample|fixture|mock|readme|docs?/"
CONFIG_PATHS = r"\.env|config|settings|\.pem|\.key|credential|deploy"

KEY_CHARS = string.ascii_letters + string.digits + "+/_=-"
#: Shortest value that a name is split off from.
SHORTEST_VALUE = 8
# The names and ``=`` that begin a run, with a value behind them. A name that may itself be a key (long, with a digit, none of the
# known names) stays. Possessive, as Java recurses for each repetition of a group that it may have to give back; for that, each
# repetition looks for the value itself.
_NAME = (rf"^(?:(?=[A-Za-z+/_-]+=|[A-Za-z0-9+/_-]{{1,{SHORTEST - 1}}}=|(?i:[a-z0-9+/_-]*?(?:{SECRET_NAMES}|{OTHER_NAMES})))"
         rf"[A-Za-z0-9+/_-]+=(?=[^=].{{{SHORTEST_VALUE - 1}}}))++")
# What ends right before a value that is assigned to a secret's name, in quotes or not, or follows ``Bearer``.
_TO_SECRET = rf"(?i)({SECRET_NAMES})[a-z0-9_.-]{{0,24}}[\"'`]?\s*(=>|:=|[=:])\s*[\"'`]?$|bearer\s+$"
_PROVIDERS = (r"^(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{22,}|glpat-[A-Za-z0-9_-]{20,}"
              r"|[rsp]k_(?:live|test)_[A-Za-z0-9]{16,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35})$")
# What names a value as a secret, up to the value, and such a value: in quotes, or without up to a space, a quote or the next field of a query.
_NAMED = (rf"(?:[A-Za-z0-9+/_=-]{{0,48}}?(?i:{SECRET_NAMES.replace('auth', 'auth(?!ors?[^a-z])')})[A-Za-z0-9_.-]{{0,24}}+\\{{0,2}}[\"'`]?+\s{{0,3}}+(?:=>|:=|[=:])\s{{0,3}}+\\{{0,2}}"
          r"|(?i:bearer)\s{1,3}+)")
_QUOTED = "|".join(rf"{q}[^{q}\s]{{{SHORTEST_VALUE},}}+(?={q})|{q}(?=\S)[^{q}\r\n]{{{SHORTEST_VALUE},128}}+(?={q})" for q in "\"'`")
_BARE = (rf"[\"'`]?+[^\s\"'`&]{{{SHORTEST_VALUE - 1},}}[^\s\"'`&,;.)\]}}](?:&(?![A-Za-z0-9_.-]+=)[^\s\"'`&]*[^\s\"'`&,;.)\]}}]){{0,8}}")
_RUN = (rf"(?<![A-Za-z0-9+/_=-])(?:{_NAMED}(?:{_QUOTED}|{_BARE})"
        rf"|(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{{{SHORTEST},}})")
# What is split off the front of a match.
_FRONT = rf"^{_NAMED}[\"'`]?(?=.{{{SHORTEST_VALUE},}}\z)|{_NAME}"
FEATURES = ("length", "transitions", "digits", "uppers", "others", "distinct", "entropy", "hex", "words", "assigned", "quoted",
            "secret_name", "other_name", "name_words", "example_path", "config_path", "path_depth", "provider")


def _per(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern)) / F.length(c)


def _chars(c: Column) -> Column:
    """Key characters that occur in a candidate, which may be too long to be split into an array."""
    return F.filter(F.array(*[F.lit(x) for x in KEY_CHARS]), lambda x: F.contains(c, x))


def _entropy(c: Column) -> Column:
    n = F.length(c)
    bits = F.transform(_chars(c), lambda x: (n - F.length(F.replace(c, x, F.lit("")))) / n)
    return F.aggregate(bits, F.lit(0.0), lambda s, p: s - F.when(p > 0, p * F.log2(p)).otherwise(0.0))


def _covered(c: Column, dictionary: Column) -> Column:
    """Share of characters that dictionary words of three letters or more cover."""
    return 1 - F.length(F.regexp_replace(F.lower(c), dictionary, F.lit(""))) / F.length(c)


def _feature_struct(c: Column, before: Column, after: Column, path: Column, dictionary: Column) -> Column:
    near = F.lower(before)
    word = lambda flag: flag.cast("double")
    return F.struct(
        F.length(c).cast("double").alias("length"),
        _per(c, "(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])|(?<=[^A-Za-z0-9])(?=[A-Za-z0-9])").alias("transitions"),
        _per(c, "[0-9]").alias("digits"), _per(c, "[A-Z]").alias("uppers"), _per(c, "[^A-Za-z0-9]").alias("others"),
        (F.size(_chars(c)) / F.length(c)).alias("distinct"),
        _entropy(c).alias("entropy"), word(c.rlike("^[0-9a-fA-F]+$")).alias("hex"),
        _covered(c, dictionary).alias("words"),
        word(before.rlike(r"[=:]\s*[\"'`]?$")).alias("assigned"),
        word(before.rlike("[\"'`]$") & after.rlike("^[\"'`]")).alias("quoted"),
        word(near.rlike(rf"({SECRET_NAMES})[^\n]{{0,12}}$")).alias("secret_name"),
        word(near.rlike(rf"({OTHER_NAMES})[^\n]{{0,12}}$")).alias("other_name"),
        _covered(F.concat(F.lit(" "), near), dictionary).alias("name_words"),
        word(path.rlike(f"(?i){EXAMPLE_PATHS}")).alias("example_path"),
        word(path.rlike(f"(?i){CONFIG_PATHS}")).alias("config_path"),
        (F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))).cast("double").alias("path_depth"),
        word(c.rlike(_PROVIDERS)).alias("provider"))


def _located(docs: DataFrame, text_col: str, path_col: str | None) -> DataFrame:
    """(_row, _path, _runs, _rest, _near): as ``with_candidates``, ``_near`` without what is known about the candidates."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")
    runs = F.regexp_extract_all(text, F.lit(_RUN), F.lit(0))
    runs = F.coalesce(runs, F.array().cast("array<string>"))
    rest = F.when(F.size(runs) > 0, F.split(text, _RUN)).otherwise(F.array(text))
    # names in front of values go to the text before them; nothing follows the last rest
    names = F.concat(F.transform("_all", lambda x: F.regexp_extract(x, _FRONT, 0)), F.array(F.lit("")))
    found = (docs.select(F.struct("*").alias("_row"), path.alias("_path"), runs.alias("_all"), rest.alias("_between"))
             .withColumn("_names", names)
             .select("_row", "_path", F.zip_with("_all", F.slice("_names", F.lit(1), F.size("_all")), lambda x, n: x.substr(F.length(n) + 1, F.length(x))).alias("_runs"),
                     F.zip_with("_between", "_names", lambda x, n: F.concat(x, n)).alias("_rest")))
    run, others = F.col("_runs"), F.col("_rest")
    # where each run begins: what is left of it, runs and rest, added up
    starts = F.aggregate(
        F.arrays_zip(F.transform(run, F.length).alias("n"), F.slice(F.transform(others, F.length), F.lit(1), F.size(run)).alias("m")),
        F.struct(F.array().cast("array<int>").alias("at"), F.lit(0).alias("end")),
        lambda s, x: F.struct(F.concat(s["at"], F.array(s["end"] + x["m"])).alias("at"), (s["end"] + x["m"] + x["n"]).alias("end")))["at"]
    between = lambda k: F.get(others, k)
    # a long name may be a candidate itself; the value behind it still has it in front
    named = lambda k: F.when((k > 0) & between(k).rlike(r"^[\"'`]?\s{0,3}(=>|:=|[=:])\s{0,3}[\"'`]?$"),
                             F.concat(F.get(run, k - 1), between(k))).otherwise(between(k))
    near = F.transform(F.arrays_zip(run.alias("c"), starts.alias("at"), F.sequence(F.lit(0), F.size(run) - 1).alias("k")),
                       lambda x: F.struct(x["at"].alias("start"), x["c"].alias("candidate"),
                                          F.substring(named(x["k"]), -48, 48).alias("before"),
                                          F.substring(between(x["k"] + 1), 1, 16).alias("after")))
    near = F.when(F.size(run) > 0, near).otherwise(
        F.array().cast("array<struct<start:int,candidate:string,before:string,after:string>>"))
    return found.withColumn("_near", near)


def with_candidates(docs: DataFrame, text_col: str = "text", path_col: str | None = None, dictionary: str = "") -> DataFrame:
    """(_row, _runs, _rest, _found): the row as a struct, its candidates, the text between them, and what is known about each.

    ``_found`` is an array of (start, candidate, before, after, f) in order of place; ``start`` counts characters from 0. Null and
    empty texts have no candidates. A candidate may be of any length.
    """
    words = F.lit(dictionary or NO_WORD)
    known = F.transform(F.col("_near"), lambda x: F.struct(
        x["start"].alias("start"), x["candidate"].alias("candidate"), x["before"].alias("before"), x["after"].alias("after"),
        _feature_struct(x["candidate"], x["before"], x["after"], F.col("_path"), words).alias("f")))
    return _located(docs, text_col, path_col).withColumn("_found", known).drop("_near", "_path")


def sampled(rows: DataFrame, most: dict[int, int]) -> DataFrame:
    """Of each label at most ``most[label]`` rows, those with the smallest hash ``_h``; ``rows`` are read twice.

    Only about the share of rows that is needed is sorted, so what goes to one task does not grow with the input.
    """
    counts = {int(r["label"]): r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}

    def of(label: int, n: int) -> DataFrame:
        own = rows.where(F.col("label") == label)
        if counts.get(label, 0) <= n:
            return own
        share = min(1.0, 1.2 * n / counts[label] + 1000 / counts[label])
        return own.where(F.pmod("_h", F.lit(1 << 40)) <= int(share * (1 << 40))).orderBy(F.pmod("_h", F.lit(1 << 40)), "_h").limit(n)

    return reduce(DataFrame.unionByName, [of(label, n) for label, n in most.items()])


def dictionary_of(docs: DataFrame, text_col: str = "text", words: int = DICTIONARY) -> str:
    """A pattern of the words of three to twelve letters that most texts have, longest first; ``words`` bounds its size.

    All texts count; ties go to the word first in the alphabet.
    """
    counted = (docs.select(F.explode(F.array_distinct(F.split(F.lower(F.col(text_col)), r"[^\p{L}]+"))).alias("w"))
               .where("length(w) between 3 and 12").groupBy("w").count().orderBy(F.desc("count"), "w").limit(words))
    found = [r["w"] for r in counted.collect()]
    return "|".join(sorted(found, key=lambda w: (-len(w), w)))


@dataclass
class Forest:
    dictionary: str = ""
    trees: list[str] = field(default_factory=list)  # share of secrets in a leaf, as SQL over the struct of features

    def score(self, f: Column) -> Column:
        """Mean over the trees; 0.5 for all where there was nothing to learn from."""
        if not self.trees:
            return F.lit(0.5)
        votes = [_grown(t, f) for t in self.trees]
        total = votes[0]
        for v in votes[1:]:
            total = total + v
        return total / len(votes)


def _grown(tree, f: Column) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    name, at, low, high = tree
    return F.when(f[name] <= at, _grown(low, f)).otherwise(_grown(high, f))


def _read_tree(lines: list[str], leaf: str = "Predict: "):
    """A tree from Spark ML's description: (feature, threshold, low, high) or a leaf."""
    line = lines.pop(0).strip()
    if line.startswith(leaf):
        return float(line.removeprefix(leaf))
    feature, at = line.removeprefix("If (feature ").rstrip(")").split(" <= ")
    low = _read_tree(lines)
    lines.pop(0)  # Else
    return FEATURES[int(feature)], float(at), low, _read_tree(lines)


def train(findings: DataFrame, dictionary: str, trees: int = 20, depth: int = 5, most: int = TRAIN_ROWS, seed: int = 6) -> Forest:
    """Forest from labelled findings: (candidate, before, after, path, label), label 1 for a real secret.

    Uses at most ``most`` rows, half of them of either label, those with the smallest hash; rows with a null are left out. Without any,
    or without a real secret among them, every candidate scores 0.5 and stays a finding: there is nothing to tell secrets by.
    ``silver_findings`` of a table with rows always has both labels.
    """
    words = F.lit(dictionary or NO_WORD)
    # written before it is counted and sampled
    every = stage(findings.select("candidate", "before", "after", F.coalesce("path", F.lit("")).alias("path"), F.col("label").cast("double"))
                  .dropna().withColumn("_h", F.xxhash64("candidate", "before", "after", "path")), "labelled")
    rows = sampled(every, {0: most - most // 2, 1: most // 2})
    known = stage(rows.select(
        _feature_struct(F.col("candidate"), F.col("before"), F.col("after"), F.col("path"), words).alias("f"), "label")
        .select("f.*", "label").repartition(4), "findings")
    kinds = {r["label"] for r in known.select("label").distinct().collect()}
    if not kinds or kinds == {0.0}:
        return Forest(dictionary)
    if len(kinds) == 1:
        return Forest(dictionary, [kinds.pop()])
    data = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(known)
    model = RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed,
                                   minInstancesPerNode=2).fit(data)
    grown = []
    for tree in model.trees:
        lines = tree.toDebugString.splitlines()[1:]
        grown.append(_read_tree(lines))
    return Forest(dictionary, grown)


def scan(docs: DataFrame, forest: Forest, text_col: str = "text", path_col: str | None = None,
         threshold: float = THRESHOLD) -> DataFrame:
    """(_row, _rest, _found): as ``with_candidates``, with ``score`` and ``is_secret`` for each candidate."""
    scored = F.transform("_found", lambda x: F.struct(x["start"].alias("start"), x["candidate"].alias("candidate"),
                                                      forest.score(x["f"]).alias("score")))
    judged = F.transform("_scored", lambda x: F.struct(x["start"].alias("start"), x["candidate"].alias("candidate"), x["score"].alias("score"),
                                                       (x["score"] >= threshold).alias("is_secret")))
    return (with_candidates(docs, text_col, path_col, forest.dictionary).withColumn("_scored", scored)
            .withColumn("_found", judged).drop("_scored", "_runs"))


def findings(docs: DataFrame, forest: Forest, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None,
             threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, start, length, sha256, score, is_secret) for every candidate; the candidate itself is not shown."""
    path = F.col(path_col).cast("string") if path_col else F.lit("")
    only = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), path.alias("path"))
    return (scan(only, forest, "text", "path", threshold).select(F.col("_row.id").alias(id_col), F.explode_outer("_found").alias("_f"))
            # an inner explode makes Spark work out all candidates again in a filter before it
            .where("_f is not null")
            .select(id_col, "_f.start", F.length("_f.candidate").alias("length"), F.sha2("_f.candidate", 256).alias("sha256"),
                    F.col("_f.score").alias("score"), "_f.is_secret"))


def redact(docs: DataFrame, forest: Forest, text_col: str = "text", path_col: str | None = None, threshold: float = THRESHOLD,
           mark: str = REDACTED) -> DataFrame:
    """The rows of ``docs`` with every secret in the text replaced by ``mark``; a null text stays null."""
    found = scan(docs, forest, text_col, path_col, threshold)
    shown = F.transform("_found", lambda x: F.when(x["is_secret"], F.lit(mark)).otherwise(x["candidate"]))
    pieces = F.zip_with("_rest", shown, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    text = F.when(F.exists("_found", lambda x: x["is_secret"]), F.array_join(pieces, "")).otherwise(F.col("_row")[text_col])
    return found.select(*[text.alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in docs.columns])


def silver_findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None,
                    most: int = TRAIN_ROWS) -> DataFrame:
    """Labelled findings from the texts themselves, where no hand-labelled ones are given.

    A run of 32 hexadecimal or 24 mixed characters that is assigned to the name of a secret, in quotes or not, or follows ``Bearer``,
    is one, and so is a key in the form of a known provider; candidates that are assigned to nothing and have no secret's name
    near are none, and neither is a reference such as ``${TOKEN}`` or a call. Each true one also gives counterexamples, the same run behind the name of something that only looks like a secret,
    and examples of other forms: without quotes, behind ``Bearer``, shorter, letters only, with other characters, as a provider's key. All texts are
    looked through; about ``most`` findings of either label are kept, those with the smallest hash. ``MADE`` made-up keys and numbers
    come on top, so a table without any secret still teaches what one looks like; a table without rows gives no findings.
    """
    path = F.col(path_col).cast("string") if path_col else F.lit("")
    some = docs.select(F.col(text_col).alias("_t"), F.coalesce(path, F.lit("")).alias("path"))
    near = (_located(some, "_t", None).select(F.col("_row.path").alias("path"), F.explode_outer("_near").alias("x"))
            .where("x is not null")
            .select("path", "x.candidate", "x.before", "x.after"))
    provider = F.col("candidate").rlike(_PROVIDERS)
    real = provider | (F.col("candidate").rlike("^[0-9a-fA-F]{32,}$|^(?=.*[a-z])(?=.*[A-Z])(?=.*[0-9])[A-Za-z0-9+/_=-]{24,}$")
                       & F.col("before").rlike(_TO_SECRET))
    loose = ~F.col("before").rlike(r"[=:]\s*[\"'`]?$") & ~F.col("before").rlike(f"(?i){SECRET_NAMES}")
    reference = F.col("candidate").rlike(r"^(?:\$|<|\{\{|%[A-Za-z(]|https?://)|^[A-Za-z_.]+[(\[]")
    known = near.withColumn("label", F.when(real, 1).when(loose | reference, 0)).where("label is not null")
    every = stage(known.withColumn("_h", F.xxhash64("candidate", "before", "after", "path")), "silver")
    return _examples(sampled(every, {0: most, 1: most}).drop("_h").unionByName(_made(docs, max(1, min(MADE, most // 8)))))


def _made(docs: DataFrame, pairs: int) -> DataFrame:
    """The same made-up findings for every table that has rows: keys assigned to a secret's name, and numbers in running text."""
    digest = F.sha2(F.col("_k").cast("string").cast("binary"), 256)
    mixed = F.substring(F.base64(F.unhex(digest)), 1, 40)
    number = F.rpad(F.conv(F.substring(digest, 1, 13), 16, 10), 16, "7")
    front = F.element_at(F.array(*[F.lit(x) for x in ("paid by card ", "order ", "see number ", "and ", "Call ")]), (F.col("_k") % 5 + 1).cast("int"))
    none = F.lit("")
    pair = F.array(
        F.struct(none.alias("path"), F.when(F.col("_k") % 2 == 0, F.substring(digest, 1, 40)).otherwise(mixed).alias("candidate"),
                 F.lit('token = "').alias("before"), F.lit('"').alias("after"), F.lit(1).alias("label")),
        F.struct(none.alias("path"), number.alias("candidate"), front.alias("before"), F.lit(" ").alias("after"), F.lit(0).alias("label")))
    return (docs.limit(1).select(F.explode(F.sequence(F.lit(1), F.lit(pairs))).alias("_k"))
            .select(F.explode(pair).alias("_x")).select("_x.*"))


def _examples(known: DataFrame) -> DataFrame:
    """Labelled findings with the counterexamples and other forms of each true one."""
    c, before = F.col("candidate"), F.col("before")

    def one_of(*texts: str, seed: int) -> Column:
        return F.element_at(F.array(*[F.lit(t) for t in texts]), (F.pmod(F.xxhash64(c, F.lit(seed)), F.lit(len(texts))) + 1).cast("int"))

    other = one_of("commit ", "sha1: ", 'md5 = "', 'checksum "', "etag: ", 'uuid ', "revision=", "digest=", seed=1)
    loose = one_of("commit ", "order ", "the ", "checksum=", "see ", "invoice: ", seed=2)
    form = one_of("export ACCESS_KEY=", "password=", "?token=", "Authorization: Bearer ", '"secret": "', "api_key: ", "PRIVATE_KEY=", seed=3)
    named = F.regexp_replace("before", _TO_SECRET, "")
    short = F.substring(c, 1, 16)
    word = F.substring(F.translate(c, "0123456789+/_=-", "qwxzkvjgpfhmrst"), 1, 20)
    mixed = F.concat(F.substring(c, 1, 5), F.lit("!"), F.substring(c, 6, 4), F.lit("@#"))
    provider = F.concat(F.lit("ghp_"), F.substring(F.concat(F.sha1(c), c), 1, 36))
    shown = lambda text, front, after, label: F.struct(text.alias("candidate"), front.alias("before"), after.alias("after"), F.lit(label).alias("label"))
    after = F.when(form.endswith('"'), F.lit('"')).otherwise(F.lit("\n"))
    true = F.array(shown(c, before, F.col("after"), 1), shown(c, F.concat(named, other), F.col("after"), 0), shown(c, form, after, 1),
                   shown(short, form, after, 1), shown(short, loose, F.lit(" "), 0), shown(c, loose, F.lit(" "), 0),
                   shown(provider, loose, F.lit(" "), 1), shown(word, form, after, 1), shown(mixed, form, after, 1))
    both = F.when(F.col("label") == 1, true).otherwise(F.array(shown(c, before, F.col("after"), 0)))
    return known.select("path", F.explode(both).alias("_x")).select("path", "_x.candidate", "_x.before", "_x.after", "_x.label")
