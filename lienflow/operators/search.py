"""Debtor-name search, lapse horizon and amendment chains."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from lienflow.functions.sql import listing, replace_all
from lienflow.functions.text import normalize_name, search_key
from lienflow.session import stored


def match_watchlist(filings: DataFrame, watchlist: DataFrame, exact_states: tuple[str, ...] = ("DE",)) -> DataFrame:
    """Filings whose debtor is on the watchlist, with the watched name.

    An equi-join on the search key, or on the plain upper-case name in states that search strictly.
    The watchlist is reduced to distinct names first.  Filings that come with a ``search_key``, as the store
    holds it, are joined on that as it is.
    """
    stored = "search_key" in filings.columns
    watched = watchlist.selectExpr(f"{normalize_name('watch_name', True)} AS watch_name").distinct()
    strict = f"concat('=', {normalize_name('debtor_name', True)})"
    # Never null, so that the join needs no null check, which would work out the key a second time.
    loose = "search_key" if stored else search_key("debtor_name")
    key = f"coalesce(if(state IN ({listing(exact_states)}), {strict}, {loose}), '') AS match_key"
    keyed = filings.selectExpr("*", key)
    keys = f"explode(array({search_key('watch_name')}, concat('=', watch_name))) AS match_key"
    entries = watched.selectExpr("watch_name", keys).filter("match_key IS NOT NULL")
    return keyed.join(entries, "match_key").drop("match_key")


def match_initials(filings: DataFrame, watchlist: DataFrame) -> DataFrame:
    """Individuals whose given name is abbreviated on one side: "J SMITH" finds "JOHN SMITH".

    Equal names join on the whole name.  Only an abbreviated name joins on its letter and the rest, so full names
    that share those are never paired.
    """

    def parts(column: str, prefix: str) -> list[str]:
        bare = normalize_name(replace_all(column, (r"[^\p{L}\p{N}\s]", "")), True)
        given = f"substring_index({bare}, ' ', 1)"
        rest = f"translate(substring({bare}, length({given}) + 1), ' ', '')"
        return [f"{given} AS {prefix}_given", f"left({given}, 1) AS initial", f"{rest} AS rest"]

    a = filings.selectExpr("*", *parts("debtor_name", "debtor"))
    b = watchlist.select("watch_name").distinct().selectExpr("*", *parts("watch_name", "watch"))
    a, b = a.filter("rest != ''"), b.filter("rest != ''")
    # Each pair in one of three joins: the same given name, or one side a single letter and the other not.
    same = a.join(b, (F.col("debtor_given") == F.col("watch_given")) & (a["rest"] == b["rest"]))
    by_letter = (a["initial"] == b["initial"]) & (a["rest"] == b["rest"])
    short_a, short_b = F.length("debtor_given") == 1, F.length("watch_given") == 1
    listed_short = a.filter(~short_a).join(b.filter(short_b), by_letter)
    filed_short = a.filter(short_a).join(b.filter(~short_b), by_letter)
    columns = [c for c in a.columns if c not in ("initial", "rest", "debtor_given")]
    parts = [part.select(*[a[c] for c in columns], "watch_name") for part in (same, listed_short, filed_short)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def lapsing(filings: DataFrame, first: str, last: str) -> DataFrame:
    """Filings that lapse within a span; the filter reaches the scan."""
    return filings.filter(F.col("lapse_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def amendment_chains(filings: DataFrame) -> DataFrame:
    """Original filings with a summary of their amendments.

    Amendments are summed up per original before the join, so an original with very many is no hot key.
    """
    kind = F.col("filing_type")
    chains = (
        filings.filter("original_filing_number is not null")
        .groupBy("state", F.col("original_filing_number").alias("filing_number"))
        .agg(
            F.count("*").alias("n_amendments"),
            F.count_if(kind == "UCC-3-CONTINUATION").alias("n_continuations"),
            F.count_if(kind == "UCC-3-TERMINATION").alias("n_terminations"),
            F.max("filing_date").alias("last_amendment"),
        )
    )
    originals = filings.filter("original_filing_number is null").select("state", "filing_number", "filing_date")
    zero = F.lit(0)
    joined = originals.join(chains, ["state", "filing_number"], "left")
    return joined.withColumns({n: F.coalesce(n, zero) for n in ("n_amendments", "n_continuations", "n_terminations")})


def chain_roots(filings: DataFrame) -> DataFrame:
    """state, filing_number, root_number and depth of each filing, however long its chain of amendments.

    The root is the first filing of the chain, at depth 0; a number that a chain leads to but that is not in the
    table is a root as well.  Filings whose chain runs in a circle, and those that lead into one, have neither root
    nor depth.  A filing stands in the table once.

    Pointers jump: each round every filing takes over what the filing that it points to knows, so that it sees twice
    as far, and a chain of a thousand amendments takes ten rounds.  Filings that have reached their root leave the
    rounds.  Both sides of a join are stored, so that the runtime splits an original with very many amendments.
    """
    rows = filings.selectExpr("state", "filing_number", "original_filing_number AS up")
    amended = stored(rows.filter("up IS NOT NULL"), "amended")
    onward = amended.selectExpr("state", "filing_number AS up", "true AS leads_on")
    pointers = amended.join(onward, ["state", "up"], "left").selectExpr(
        "state", "filing_number", "up", "1L AS depth", "leads_on IS NULL AS at_root"
    )
    pointers = stored(pointers, "pointers")
    known, still = [pointers.filter("at_root")], pointers.filter("NOT at_root")
    left = still.count()
    while left:
        seen = reduce(DataFrame.unionByName, [*known, still])
        further = seen.selectExpr("state", "filing_number AS up", "up AS next", "depth AS more", "at_root")
        jumped = still.drop("at_root").join(further, ["state", "up"])
        jumped = stored(jumped.selectExpr("state", "filing_number", "next AS up", "depth + more AS depth", "at_root"), "pointers")
        known.append(jumped.filter("at_root"))
        still = jumped.filter("NOT at_root")
        before, left = left, still.count()
        # Of an open chain some filing reaches the root in every round; what is left when none does are circles.
        if left == before:
            break
    first = rows.filter("up IS NULL").selectExpr("state", "filing_number", "filing_number AS root_number", "0L AS depth")
    found = reduce(DataFrame.unionByName, known).selectExpr("state", "filing_number", "up AS root_number", "depth")
    circles = still.selectExpr("state", "filing_number", "string(NULL) AS root_number", "bigint(NULL) AS depth")
    return first.unionByName(found).unionByName(circles)


def whole_chains(filings: DataFrame, term_months: int = 60, window_months: int = 6) -> DataFrame:
    """Original filings with a summary of all amendments of their chains, and when they lapse in effect.

    A continuation counts when it is filed within the window before the lapse as it then is; it moves the lapse by a
    term.  Further ones in the same window are of no effect.  Without a lapse date the first term begins with the
    filing.  Chains are summed up per root before the join; the different dates of a chain's continuations, which the
    calendar bounds, are all that is collected of it.
    """
    kind = F.col("filing_type")
    roots = stored(chain_roots(filings), "chain-roots").filter("depth > 0")
    amendments = filings.select("state", "filing_number", "filing_type", "filing_date").join(roots, ["state", "filing_number"])
    chains = amendments.groupBy("state", F.col("root_number").alias("filing_number")).agg(
        F.count("*").alias("n_amendments"),
        F.max("depth").alias("depth"),
        F.count_if(kind == "UCC-3-CONTINUATION").alias("n_continuations"),
        F.max("filing_date").alias("last_amendment"),
        F.min(F.when(kind == "UCC-3-TERMINATION", F.col("filing_date"))).alias("terminated_on"),
        F.array_sort(F.collect_set(F.when(kind == "UCC-3-CONTINUATION", F.col("filing_date")))).alias("continued"),
    )
    fields = ["state", "filing_number", "filing_date", "lapse_date"]
    originals = filings.filter("original_filing_number IS NULL").select(*fields)
    first = f"coalesce(lapse_date, add_months(filing_date, {term_months}))"
    in_time = f"d BETWEEN add_months(lapse, -{window_months}) AND lapse"
    lapse = f"aggregate(continued, {first}, (lapse, d) -> if({in_time}, add_months(lapse, {term_months}), lapse))"
    joined = originals.join(chains, ["state", "filing_number"], "left").withColumn("effective_lapse", F.expr(f"coalesce({lapse}, {first})"))
    zeros = {n: F.coalesce(n, F.lit(0).cast("long")) for n in ("n_amendments", "depth", "n_continuations")}
    return joined.withColumns(zeros).drop("continued")


def orphan_amendments(filings: DataFrame) -> DataFrame:
    """Amendments whose original filing is not in the table."""
    amendments = filings.filter("original_filing_number is not null")
    keys = filings.select("state", F.col("filing_number").alias("original_filing_number"))
    return amendments.join(keys, ["state", "original_filing_number"], "left_anti")
