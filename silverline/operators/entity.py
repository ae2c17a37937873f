"""Entity-name normalisation (ENT-1..3, WIN-3).

* ENT-1 rewrites a name with an ordered list of regex rules, then maps known
  aliases to one standard spelling.  Rules and aliases are inputs; the
  reference's algorithm rules and alias table are the default preset.
* ENT-2 picks one canonical spelling for every group of names that agree
  after lowercasing and dropping non-alphanumerics.  No driver-side dict: the
  mapping is an aggregate joined back.
* ENT-3 reports groups of distinct names that collide under that key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverline.functions import strings as S
from silverline.operators.joins import literal_map


@dataclass(frozen=True)
class Rewrite:
    """One regex rewrite.  ``first_only`` replaces the first match only."""

    pattern: str
    replacement: str
    first_only: bool = False

    def apply(self, c: Column) -> Column:
        if self.first_only:
            return S.replace_first(c, self.pattern, self.replacement)
        return S.replace_all(c, self.pattern, self.replacement)


@dataclass(frozen=True)
class ExactRewrite:
    """Replace a whole value that equals ``value`` exactly."""

    value: str
    replacement: str

    def apply(self, c: Column) -> Column:
        return F.when(c == F.lit(self.value), F.lit(self.replacement)).otherwise(c)


# The reference's algorithm-name rewrite rules, in their order.
ALGORITHM_REWRITES = (
    Rewrite(r"(?i)cryptonight[-_ ]?", "CryptoNight-", first_only=True),
    ExactRewrite("CryptoNight-", "CryptoNight"),
    Rewrite(r"(?i)equihash(?:[(, ]*)(\d+)[,_ ](\d+)(?:[), ]*)", "Equihash($1,$2)", first_only=True),
    Rewrite(r"(?i)\b(cuckatoo)", "Cuckatoo"),
    Rewrite(r"(?i)\b(SHA 2)", "SHA-2"),
    Rewrite(r"(?i)\b(sha3)", "SHA3"),
)

# The reference's alias table (standard name -> reported
# spellings), in its order.  "NexaPow" is listed twice there; keys are
# de-duplicated when the lookup map is built.
ALGORITHM_ALIASES: dict[str, list[str]] = {
    "Blake256": ["Blake 256", "Blake256", "BLAKE256"],
    "Blake2B": ["Blake2b", "Blake (2b)"],
    "Blake2B + SHA3": ["Blake2b Sha3", "Blake2b SHA3", "Blake (2b) + SHA3", "Blake2B SHA3"],
    "Blake2S": ["Blake2s", "Blake (2s)"],
    "Blake2B-Sia": ["Blake2b-Sia", "Blake (2b)-Sia", "Blake (2b-Sia)"],
    "BMW512": ["BMW 512", "BMW512", "BMW-512", "bmw512", "Bmw512"],
    "CPUPower": ["CPU Power", "CPUpower"],
    "CryptoNight-Alloy": ["Cryptonight Alloy", "CryptoNight Alloy"],
    "CryptoNight-GPU": ["Cryptonight GPU", "CryptoNight GPU"],
    "CryptoNight-Heavy": ["Cryptonight Heavy", "CryptoNight Heavy"],
    "CryptoNight-Lite": ["Cryptonight Lite", "CryptoNight-lite", "CryptoNight Lite"],
    "CryptoNight-V7": ["Cryptonight V7", "CryptoNight V7", "CryptoNightV7"],
    "CuckooCycle": ["Cuckoo Cycle"],
    "Cuckaroo29s": ["Cuckaroo29S"],
    "Equihash Scrypt": ["Equihash-Scrypt", "EquihashScrypt", "Equihash+Scrypt"],
    "Equihash(125,4)": ["Equihash 125,4"],
    "Equihash(144,5)": ["Equihash 144,5", "Equihash1445", "Equihash 144_5"],
    "Equihash(150,5)": ["Equihash 150,5"],
    "Equihash(192,7)": ["Equihash 192,7", "Equihash1927", "Equihash 192_7"],
    "Equihash(210,9)": ["Equihash210,9", "Equihash 210,9"],
    "Equihash(96,5)": ["Equihash 96,5", "Equihash 96_5"],
    "FiroPoW": ["Firo Pow", "FiroPoW", "FiroPow"],
    "Handshake": ["HandShake"],
    "KarlsenHash": ["Karlsenhash"],
    "KarlsenHashV2": ["Karlsenhashv2", "KarlsenHash v2"],
    "KawPow": ["Kaw Pow", "KawPow", "KAWPOW"],
    "Keccak": ["KECCAK"],
    "Keccak-256 (SHA-3)": ["KECCAK-256 (SHA-3)"],
    "KHeavyHash": ["kHeavyHash"],
    "LPoS": ["LPos", "LPoS", "LPOS"],
    "Lyra2-MintMe": ["Lyra2 MintMe", "Lyra2 MintMe version", "Lyra2-MintMe version"],
    "Lyra2Z": ["Lyra2z"],
    "M7M": ["m7m"],
    "Mega-BTX": ["MegaBTX", "Mega BTX"],
    "Myriad-Groestl": ["Myr-Groestl", "Myriad Groestl"],
    "NexaPoW": ["Nexa Pow", "NexaPow", "NEXAPOW", "NexaPow", "NexaHash", "Nexahash"],
    "PoD": ["POD"],
    "Quark": ["QUARK", "quark"],
    "QuBit": ["Qubit", "QUbit", "qubit"],
    "SHA-256": ["SHA-256D", "SHA256", "SHA256D", "SHA 256"],
    "SHA256DT": ["SHA256dT", "SHA-256dT"],
    "Time Travel": ["Timetravel", "Time Travel", "TimeTravel"],
    "VerusHash": ["Verus hash", "VerusHash", "Verushash"],
    "XEVAN": ["Xevan"],
    "YesPower": ["YesPower", "Yespower", "YesPoWer"],
    "YesPowerR16": ["YesPoWerR16"],
    "Yescrypt": ["Yescript", "YesCript", "yescript", "Yescrypt"],
    "X11GOST": ["X11 Gost", "X11Gost"],
    "XelisHash-V2": ["Xelishashv2"],
    "XelisHash-V3": ["Xelishashv3"],
}


def alias_mapping(aliases: dict[str, list[str]]) -> dict[str, str]:
    """standard -> aliases  ==>  alias -> standard, duplicates removed.  One
    alias claimed by two standard names is an error."""
    out: dict[str, str] = {}
    for standard, spellings in aliases.items():
        for a in spellings:
            if a in out and out[a] != standard:
                raise ValueError(f"alias {a!r} maps to both {out[a]!r} and {standard!r}")
            out[a] = standard
    return out


def apply_rewrites(c: Column, rules=ALGORITHM_REWRITES) -> Column:
    for r in rules:
        c = r.apply(c)
    return c


def normalize_names(c: Column, rules=ALGORITHM_REWRITES,
                    aliases: dict[str, list[str]] | None = None,
                    pre=None, post=None) -> Column:
    """ENT-1: ``pre`` hook -> regex rules in order -> exact alias lookup
    (unmapped keeps its value) -> ``post`` hook.  NULL stays NULL."""
    if pre is not None:
        c = pre(c)
    c = apply_rewrites(c, rules)
    mapping = alias_mapping(ALGORITHM_ALIASES if aliases is None else aliases)
    if mapping:
        c = F.coalesce(literal_map(mapping)[c], c)
    if post is not None:
        c = post(c)
    return c


def normalize_names_table(df: DataFrame, col: str, out: str, alias_table: DataFrame,
                          alias_col: str = "alias", standard_col: str = "standard",
                          rules=ALGORITHM_REWRITES) -> DataFrame:
    """ENT-1 with the alias table as a DataFrame (user-maintained, may be
    large): rewrite, then a left join on the rewritten name; AQE picks the
    join from the sizes it has measured."""
    t = (alias_table.select(F.col(alias_col).alias("_alias"), F.col(standard_col).alias("_std"))
         .dropDuplicates(["_alias"]))
    rewritten = df.withColumn("_rw", apply_rewrites(F.col(col), rules))
    j = rewritten.join(t, F.col("_rw") == F.col("_alias"), "left")
    return j.withColumn(out, F.coalesce(F.col("_std"), F.col("_rw"))).drop("_rw", "_alias", "_std")


def canonical_names(df: DataFrame, name_col: str, out_col: str = "canonical_name",
                    on_empty_key: str = "keep", key_fn=S.match_key) -> DataFrame:
    """ENT-2 / WIN-3: every name -> the smallest spelling among names with the
    same match key.  A canonical NULL or ``''`` leaves each name as itself.

    ``on_empty_key``: names with no ASCII letter or digit share key ``''``.
    ``"keep"`` (default) leaves each of them as itself; ``"merge"`` is the
    reference's behaviour (they take the smallest of them, unless ``''`` is
    among them).

    Plan: ``groupBy(key).agg(min(name))`` is a partial+final aggregate, so a
    hot key is pre-combined map-side; the (key -> canonical) table has one row
    per distinct key and is joined back.  The plan is lazy: AQE broadcasts the
    table once its size is known to be small, else it shuffles and splits skew.
    """
    if on_empty_key not in ("keep", "merge"):
        raise ValueError("on_empty_key must be 'keep' or 'merge'")
    keyed = df.withColumn("_nk", key_fn(F.col(name_col)))
    canon = (keyed.filter(F.col("_nk").isNotNull())
             .groupBy("_nk").agg(F.min(name_col).alias("_canon")))
    if on_empty_key == "keep":
        canon = canon.filter(F.col("_nk") != "")
    j = keyed.join(canon, "_nk", "left")
    pick = F.when(F.col("_canon").isNull() | (F.col("_canon") == ""), F.col(name_col)).otherwise(F.col("_canon"))
    return j.withColumn(out_col, pick).drop("_nk", "_canon")


#: Names in one row of a list.
LISTED_NAMES = 1000


def alias_opportunities(df: DataFrame, name_col: str, key_fn=S.match_key,
                        skip_empty_key: bool = False) -> DataFrame:
    """ENT-3: groups of distinct names that collide under the match key, as
    rows ``(name_key, names_json, n_names)``; names sorted.  Distinct names
    are taken first so the collected lists hold only distinct spellings.
    Names with no ASCII letter or digit all share key ``''`` and are reported
    as one group, unless ``skip_empty_key``.  A group of more than
    ``LISTED_NAMES`` names comes in several rows of about that many names;
    ``n_names`` counts the whole group in each."""
    keyed = alias_collisions(df, name_col, key_fn)
    if skip_empty_key:
        keyed = keyed.filter(F.col("name_key") != "")
    part = F.pmod(F.xxhash64("name"), F.ceil(F.col("n_names") / LISTED_NAMES))
    g = keyed.groupBy("name_key", "n_names", part.alias("_part")).agg(F.array_sort(F.collect_list("name")).alias("_names"))
    return g.select("name_key", F.to_json("_names").alias("names_json"), "n_names")


def alias_collisions(df: DataFrame, name_col: str, key_fn=S.match_key) -> DataFrame:
    """ENT-3 in long form: rows ``(name_key, name, n_names)`` of all names that
    collide under the match key.  No list is built, so a key may have any
    number of names."""
    names = df.select(F.col(name_col).alias("name")).filter(F.col("name").isNotNull()).distinct()
    keyed = names.withColumn("name_key", key_fn(F.col("name")))
    sizes = keyed.groupBy("name_key").agg(F.count(F.lit(1)).alias("n_names")).filter(F.col("n_names") > 1)
    return keyed.join(sizes, "name_key").select("name_key", "name", "n_names")
