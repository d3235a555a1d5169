"""Free-entered values to the entries of a reference list.

Symmetric deletes: every spelling of an entry (its name, its reading, the reading
in Latin letters) is stored with each string that up to two deletions leave of
it; a value's own deletes are looked up there, so both sides meet by equality. At the
end of a name one deletion may take several letters if other entries end with them
too: the common word that closes a name, or the rest of one. The
dictionary is broadcast while its rows are few, else joined by shuffle. What is
found is ranked by a weighted Damerau-Levenshtein distance and the frequency of the
entry. A substitution counts little only where no entry has the written character
at that place, and only for the character it stands for most often over all
values; characters that other entries use make another name, not a slip. Names
that are typed but not listed take part as entries of their own, so that a slip
in one of them is not drawn to a listed name beside it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm import distances as D
from folioforge.llm.codepoints import one_form, with_form
from folioforge.llm.kana import hiragana, loose_latin, romaji, to_hiragana
from folioforge.runtime import checked_broadcast, materialize

# Forms of companies and the words around a publisher's name.
COMPANY = ["株式会社", "有限会社", "合同会社", "合資会社", "合名会社", "一般社団法人", "一般財団法人", "公益社団法人", "公益財団法人"]
BEFORE = ["発売元", "発行元", "発売所", "発行所", "発行者", "発行", "発売", "製作", "制作"]
AFTER = ["発行", "発売", "刊行", "刊", "編集部", "編集室", "出版部"]
DROPPED, SWAPPED, DOUBLED, CUT, END, SLIP, OTHER = 0.9, 0.6, 0.4, 0.5, 0.7, 0.8, 3.0


def _formed(words: list[str]) -> str:
    return "|".join(one_form(pa.array(words)).to_pylist())


def bare_value(form: Column) -> Column:
    """The name inside a typed value: no company form, place, trade words, brackets or blanks; hiragana, lower case."""
    v = F.lower(form)
    v = F.regexp_replace(v, rf"[㈱㈲㈳㈶㈴㈾]|{_formed(COMPANY)}|\((?:株|有|同|資|名|社|財|合)\)+|\bco\.?,? ?ltd\.?|\binc\.|\bk\.?k\.?(?=\s|$)", "")
    v = F.regexp_replace(v, r"^[\s\[「『【〈]+|[\s\]」』】〉]+$", "")
    v = F.regexp_replace(v, rf"^(?:{_formed(BEFORE)})\s*[:/]?\s*|^[^:]{{1,5}}:\s*", "")
    v = F.regexp_replace(v, r"\s*\([^()]*\)+$|[/,、][^/,、]{1,6}$", "")
    v = F.regexp_replace(v, rf"(?<=.{{2}})\s*(?:{_formed(AFTER)})$", "")
    return hiragana(F.regexp_replace(v, r"[\s\p{P}\p{S}&&[^ー]]", ""))


def deletes(text: str, most: int) -> set[str]:
    """The strings that up to ``most`` deletions leave, at least one character long."""
    out, level = {text}, {text}
    for _ in range(most):
        level = {t[:i] + t[i + 1 :] for t in level if len(t) > 1 for i in range(len(t))}
        out |= level
    return out


def reach(text: str) -> int:
    """Deletions allowed: short names are told apart by single characters."""
    return 0 if len(text) < 3 else 1 if len(text) < 5 else 2


def weighted(values: list[str], forms: list[str], strict: np.ndarray, alphabet: np.ndarray, most: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(cost, slips, wrote, meant)`` of typing each value for its form, all pairs in step; infinite beyond ``most``.

    ``alphabet``: sorted ``place << 21 | code point`` of the characters that entries have at a place; writing one of
    them for another is another name, anything else a slip. In ``strict`` pairs every substitution is another name.
    ``slips`` counts those of the cheapest way, ``wrote`` and ``meant`` are the code points of its first.
    """

    def run(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray, strict: np.ndarray) -> tuple[np.ndarray, ...]:
        count = len(x)
        best = np.full((x.shape[1] + 1, y.shape[1] + 1, count), np.inf)
        slips, wrote, meant = (np.zeros(best.shape, dtype=np.int32) for _ in range(3))
        best[0, 0] = 0.0

        def reach_by(i: int, j: int, a: int, b: int, cost: np.ndarray, slip: np.ndarray | None = None) -> None:
            new = best[i, j] + cost
            won = new < best[a, b]
            best[a, b] = np.where(won, new, best[a, b])
            for o, fresh in ((slips, 1), (wrote, x[:, i] if slip is not None else 0), (meant, y[:, j] if slip is not None else 0)):
                was = o[i, j]
                if slip is not None:
                    was = np.where(slip, was + 1 if o is slips else np.where(slips[i, j] == 0, fresh, was), was)
                o[a, b] = np.where(won, was, o[a, b])

        # a letter more or less costs DOUBLED at least, so dearer ways leave the band
        band = int(most / DOUBLED)
        for i in range(x.shape[1] + 1):
            for j in range(max(0, i - band), min(y.shape[1], i + band) + 1):
                live = (i <= n) & (j <= m) & (best[i, j] <= most)
                if not live.any():
                    continue
                here = np.where(live, 0.0, np.inf)
                if i < x.shape[1] and j < y.shape[1]:
                    same = x[:, i] == y[:, j]
                    other = strict | _known(alphabet, j, x[:, i])
                    reach_by(i, j, i + 1, j + 1, here + np.where(same, 0.0, np.where(other, OTHER, SLIP)), ~same & ~other)
                    if i + 1 < x.shape[1] and j + 1 < y.shape[1]:
                        swap = (x[:, i] == y[:, j + 1]) & (x[:, i + 1] == y[:, j]) & (x[:, i] != x[:, i + 1])
                        reach_by(i, j, i + 2, j + 2, here + np.where(swap, SWAPPED, np.inf))
                if i < x.shape[1]:
                    twice = x[:, i] == x[:, i - 1] if i else np.zeros(count, dtype=bool)
                    reach_by(i, j, i + 1, j, here + np.where(twice, DOUBLED, np.where(j == m, CUT, DROPPED)))
                if j < y.shape[1]:
                    reach_by(i, j, i, j + 1, here + np.where(i == n, CUT, DROPPED))
        at = np.arange(count)
        return tuple(o[n, m, at] for o in (best, slips, wrote, meant))

    if not len(values):
        return np.zeros(0), np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int32)
    return D.in_slices(values, forms, run, strict, cells=60_000)


def _known(alphabet: np.ndarray, place: int, codes: np.ndarray) -> np.ndarray:
    want = (place << 21) | codes.astype(np.int64)
    at = np.minimum(np.searchsorted(alphabet, want), max(len(alphabet) - 1, 0))
    return alphabet[at] == want if len(alphabet) else np.zeros(len(codes), dtype=bool)


def map_to_list(values: DataFrame, entries: DataFrame, *, most_cost: float = 1.5) -> DataFrame:
    """``(value, entry, cost)``: each distinct value's entry; ``entry`` is null for a value that has none.

    ``values``: ``value`` and ``n`` (how often it occurs); ``entries``: ``entry``,
    ``name``, ``reading``. Blank and null values have no row. Of equally near
    entries the one written out most often wins, then the lesser id. Empty tables
    give no rows or only misses.
    """
    typed = with_form(values.where("value is not null").groupBy("value").agg(F.sum("n").alias("n")), "value").select("value", "n", bare_value(F.col("form")).alias("bare")).where("length(trim(value)) > 0")
    typed = materialize(typed, "values")
    listed = with_form(entries.where("entry is not null and name is not null"), "name").select("entry", "name", bare_value(F.col("form")).alias("bare"), hiragana(F.coalesce("reading", F.lit(""))).alias("reading"))
    uses = typed.select(F.col("value").alias("name"), F.col("n").alias("uses"))
    listed = materialize(listed.join(uses, "name", "left").groupBy("entry", "bare", "reading").agg(F.coalesce(F.sum("uses"), F.lit(0)).alias("uses")), "entries")
    # places and characters of all names: bounded by the writing system, not by the data
    chars = listed.select(F.posexplode(F.split("bare", ""))).where("col <> ''").distinct().collect()
    alphabet = np.array(sorted(r[0] << 21 | ord(r[1]) for r in chars), dtype=np.int64)
    known = frozenset(r[1] for r in chars)
    # letters at the end of an entry that another entry ends with too; at least two stay before them
    tails = listed.select("bare").distinct().select("bare", F.explode(F.sequence(F.lit(1), F.greatest(F.length("bare") - 2, F.lit(1)))).alias("k")).where("k <= length(bare) - 2").withColumn("tail", F.expr("right(bare, k)"))
    tails = materialize(tails.groupBy("tail").agg(F.count_distinct("bare").alias("n")).where("n > 1").select("tail"), "tails")
    # a value longer than every form by more than the deletions allowed meets none of them, and an unlisted name longer by more than twice that stands beside none that does
    longest = (listed.agg(F.max(F.greatest(F.length("bare"), 2 * F.length("reading")))).first()[0] or 0) + 2
    first = _nearest(typed, listed, tails, alphabet, most_cost, longest)
    # typed names that are near no entry and use the entries' characters throughout
    plain = F.length(F.translate("bare", "".join(sorted(known)), "")) == 0
    own = first.where("entry is null").select("value").join(typed, "value").where(plain & F.length("bare").between(3, longest + 2)).groupBy("bare").agg(F.sum("n").alias("uses"))
    own = materialize(own.select(F.lit(None).cast(entries.schema["entry"].dataType).alias("entry"), "bare", F.lit("").alias("reading"), "uses"), "unlisted")
    return _nearest(typed, listed.select("entry", "bare", "reading", "uses").union(own), tails, alphabet, most_cost, longest)


def _nearest(typed: DataFrame, listed: DataFrame, tails: DataFrame, alphabet: np.ndarray, most_cost: float, longest: int) -> DataFrame:
    def spellings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for n, (bare, reading, ends) in enumerate(pdf[["bare", "reading", "ends"]].itertuples(index=False)):
                for kind, form in (("name", bare), ("reading", reading), ("latin", loose_latin(romaji(reading)))):
                    if form and not (kind == "reading" and form == bare):
                        rows += [(d, n, kind, form) for d in deletes(form, reach(form) if kind == "name" else 1)]
                # one deletion of what other entries end with too
                rows += [(bare[:-k], n, "end", bare) for k in ([] if ends is None else ends)]
            if not rows:
                continue
            out = pd.DataFrame(rows, columns=["d", "at", "kind", "form"])
            yield out.assign(entry=pdf["entry"].to_numpy()[out["at"]], uses=pdf["uses"].to_numpy()[out["at"]])[["d", "entry", "kind", "form", "uses"]]

    def lookups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for value, bare in pdf[["value", "bare"]].itertuples(index=False):
                if not bare or len(bare) > longest:
                    continue
                form = loose_latin(bare) if bare.isascii() else bare
                rows += [(d, value, form) for d in deletes(form, 1 if bare.isascii() else reach(form)) | {bare}]
            yield pd.DataFrame(rows, columns=["d", "value", "bare"])

    entry_type = listed.schema["entry"].dataType.simpleString()
    cuts = listed.select("bare").distinct().select("bare", F.explode(F.sequence(F.lit(1), F.greatest(F.length("bare") - 2, F.lit(1)))).alias("k")).where("k <= length(bare) - 2").withColumn("tail", F.expr("right(bare, k)"))
    cuts = cuts.join(tails, "tail").groupBy("bare").agg(F.collect_set("k").alias("ends"))
    dictionary = listed.join(cuts, "bare", "left").select("entry", "bare", "reading", "uses", "ends").mapInPandas(spellings, f"d string, entry {entry_type}, kind string, form string, uses long")
    meets = typed.mapInPandas(lookups, "d string, value string, bare string").join(checked_broadcast(materialize(dictionary, "deletes")), "d").select("value", "bare", "entry", "kind", "form", "uses").distinct()

    def costs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            bares, forms, kinds = pdf["bare"].tolist(), pdf["form"].tolist(), pdf["kind"].to_numpy()
            ends = kinds == "end"
            # readings of different names differ by single letters: only cuts, doublings and swaps are slips there
            strict = ~np.isin(kinds, ["name", "end"])
            whole = np.fromiter((f.startswith(b) for b, f in zip(bares, forms)), dtype=bool, count=len(bares))
            equal = np.fromiter((f == b for b, f in zip(bares, forms)), dtype=bool, count=len(bares))
            cost = np.where(ends, np.where(whole, END, np.inf), 0.0)
            slips, wrote, meant = (np.zeros(len(bares), dtype=np.int32) for _ in range(3))
            ask = np.flatnonzero(~ends & ~equal)
            cost[ask], slips[ask], wrote[ask], meant[ask] = weighted([bares[k] for k in ask], [forms[k] for k in ask], strict[ask], alphabet, most_cost)
            cost = np.where(strict, cost + 0.1, cost)
            kept = np.flatnonzero(cost <= most_cost)
            letter = lambda codes: [chr(c) if k else None for c, k in zip(codes[kept].tolist(), slips[kept].tolist())]
            part = pdf.iloc[kept][["value", "entry", "form", "uses"]].reset_index(drop=True)
            yield part.assign(cost=cost[kept], wrote=letter(wrote), meant=letter(meant), slips=slips[kept])

    ranked = materialize(meets.mapInPandas(costs, f"value string, entry {entry_type}, form string, uses long, cost double, wrote string, meant string, slips int"), "costs")
    # which character a stray one stands for: the one it replaces in most names, then the one nearest in the code chart (ordered by radical)
    support = ranked.where("slips = 1").groupBy("wrote", "meant").agg(F.count_distinct("form").alias("k"))
    far = F.abs(F.ascii("wrote") - F.ascii("meant"))
    stands = support.groupBy("wrote").agg(F.max(F.struct("k", (-far).alias("near"), "meant"))["meant"].alias("meant")).withColumn("usual", F.lit(True))
    fair = ranked.join(stands, ["wrote", "meant"], "left").where("slips = 0 or usual")
    best = fair.groupBy("value").agg(F.min(F.struct("cost", (-F.col("uses")).alias("u"), "entry")).alias("b"))
    return typed.select("value").join(best, "value", "left").select("value", F.col("b.entry").alias("entry"), F.when(F.col("b.entry").isNotNull(), F.col("b.cost")).alias("cost"))


def entry_of_records(rows: DataFrame, mapped: DataFrame, by: list[str], none: int = 0) -> DataFrame:
    """``(*by, entry)``: the entry that most of a record's values name; ``none`` where no value has one.

    ``rows``: the record's columns and ``value``; repeated values count by their rows, and near values before far ones in ties.
    """
    each = rows.groupBy(*by, "value").agg(F.count(F.lit(1)).alias("k")).join(mapped, "value")
    votes = each.groupBy(*by, "entry").agg(F.sum("k").alias("k"), F.min("cost").alias("cost"))
    pick = F.max(F.struct(F.col("entry").isNotNull().alias("named"), "k", (-F.col("cost")).alias("near"), (-F.col("entry")).alias("e")))
    return votes.groupBy(*by).agg(pick.alias("b")).select(*by, F.when(F.col("b.named"), -F.col("b.e")).otherwise(F.lit(none)).alias("entry"))
