"""Addresses in tables of ranges: IPv4 and IPv6 hosts against any number of CIDR blocks, by equal prefixes.

An address lies in a block when their first bits are equal. So an address looks for itself shortened to each length that the
table has (at most 33 and 129 of them), which is an equi-join: no nested loop, no list of ranges in the plan. Built-in functions
only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgmill.functions import expressions as X
from orgmill.functions import fixed
from orgmill.shared import stored

#: Blocks that may be broadcast (about 60 bytes each).
BROADCAST = 200_000


def let(value: Column, then) -> Column:
    """then(value), with value worked out once and not written out wherever then uses it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def bare(host: Column) -> Column:
    """Lower case, without the brackets and the zone of an IPv6 address."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(host)), r"^\[(.*)\]$", "$1"), "%.*$", "")


def hex4(c: Column) -> Column:
    """The 8 hexadecimal digits of a dotted IPv4 address; null for anything else."""
    return let(c, lambda x: F.lower(F.lpad(F.hex(X.ipv4(x)), 8, "0")))


def hex6(c: Column) -> Column:
    """The 32 hexadecimal digits of an IPv6 address, also with :: or a dotted end; null for anything else."""
    none = F.array().cast("array<string>")
    groups = lambda s: F.when(s == "", none).otherwise(F.split(s, ":", -1))

    def filled(sides: Column) -> Column:
        """Of what stands before :: and after it."""
        both = F.struct(groups(sides[0]).alias("left"), F.when(F.size(sides) > 1, groups(F.try_element_at(sides, F.lit(2)))).otherwise(none).alias("right"), F.size(sides).alias("n"))
        return let(both, whole)

    def whole(x: Column) -> Column:
        missing = 8 - F.size(x["left"]) - F.size(x["right"])
        right_form = F.forall(F.concat(x["left"], x["right"]), lambda g: g.rlike("^[0-9a-f]{1,4}$")) & F.when(x["n"] == 2, missing >= 1).otherwise((x["n"] == 1) & (missing == 0))
        every = F.concat(x["left"], F.array_repeat(F.lit("0"), F.greatest(missing, F.lit(0))), x["right"])
        return F.when(right_form, F.array_join(F.transform(every, lambda g: F.lpad(g, 4, "0")), ""))

    def plain(x: Column) -> Column:
        """A dotted end as two groups; null if the end is no address."""
        digits = lambda d: F.concat(F.regexp_extract(x, r"^(.*:)\d+\.\d+\.\d+\.\d+$", 1), F.left(d, F.lit(4)), F.lit(":"), F.right(d, F.lit(4)))
        return F.when(x.contains("."), let(hex4(F.regexp_extract(x, r":(\d+\.\d+\.\d+\.\d+)$", 1)), digits)).otherwise(x)

    return let(plain(c), lambda x: F.when(x.contains(":"), filled(F.split(x, "::", -1))))


def unmapped(digits: Column) -> Column:
    """IPv4 digits of an IPv4 address that is written as IPv6, else the digits."""
    return let(digits, lambda x: F.when((F.length(x) == 32) & (F.left(x, F.lit(24)) == "00000000000000000000ffff"), F.right(x, F.lit(8))).otherwise(x))


def address(host: Column) -> Column:
    """The digits of an address: 8 of IPv4 (also when written as IPv6), 32 of IPv6; null if the host is none."""
    return let(bare(host), lambda x: F.coalesce(hex4(x), unmapped(hex6(x))))


def prefix(digits: Column, bits: Column) -> Column:
    """The first bits of hexadecimal digits, as text: whole digits, and the rest of the next digit."""
    whole, rest = F.floor(bits / 4).cast("int"), bits % 4
    nibble = F.conv(F.substr(digits, whole + 1, F.lit(1)), 16, 10).cast("int")
    cut = F.when(rest == 0, "").otherwise(F.concat(F.lit("+"), F.floor(nibble / F.pow(F.lit(2), 4 - rest)).cast("int").cast("string")))
    return F.concat(F.left(digits, whole), cut)


def blocks(ranges: DataFrame, cidr: str) -> DataFrame:
    """block (the cidr as it is written), width (digits), bits and key of each range; ones that are no ranges drop out. A bare
    address is a block of itself."""
    text = F.trim(cidr)
    bits = F.nullif(F.regexp_extract(text, r"/(\d{1,3})$", 1), F.lit("")).cast("int")
    host = bare(F.regexp_replace(text, r"/\d{1,3}$", ""))
    own = ranges.select(F.col(cidr).alias("block"), F.coalesce(hex4(host), hex6(host)).alias("digits"), bits.alias("bits"), (~text.contains("/")).alias("one"))
    own = own.withColumn("width", F.length("digits")).withColumn("bits", F.when(F.col("one"), 4 * F.col("width")).otherwise(F.col("bits")))
    own = own.where("digits is not null and bits between 0 and 4 * width")
    # ::ffff:0:0/96 and longer are IPv4 blocks, as addresses written that way are IPv4
    mapped = (F.col("width") == 32) & (F.left("digits", F.lit(24)) == "00000000000000000000ffff") & (F.col("bits") >= 96)
    own = own.select("block", F.when(mapped, F.right("digits", F.lit(8))).otherwise(F.col("digits")).alias("digits"), F.when(mapped, F.col("bits") - 96).otherwise(F.col("bits")).alias("bits"), F.when(mapped, 8).otherwise(F.col("width")).alias("width"))
    return own.select("block", "width", "bits", prefix(F.col("digits"), F.col("bits")).alias("key")).distinct()


def blocks_of(hosts: DataFrame, host: str, ranges: DataFrame, cidr: str) -> DataFrame:
    """host, block for each distinct host and each block that holds it."""
    table = stored(blocks(ranges, cidr), "blocks")
    sizes = table.groupBy("width").agg(F.sort_array(F.collect_set("bits")).alias("bits"), F.count("*").alias("n")).collect()  # two rows
    lengths = {r["width"]: r["bits"] for r in sizes}
    tried = F.when(F.col("width") == 8, F.array(*[F.lit(b) for b in lengths.get(8, [])]).cast("array<int>")).otherwise(F.array(*[F.lit(b) for b in lengths.get(32, [])]).cast("array<int>"))
    own = hosts.select(F.col(host).alias("host")).where("host is not null").distinct().withColumn("digits", address(F.col("host"))).where("digits is not null").withColumn("width", F.length("digits"))
    keyed = own.withColumn("bits", F.explode(tried)).withColumn("key", prefix(F.col("digits"), F.col("bits"))).select("host", "width", "bits", "key")
    few = sum(r["n"] for r in sizes) <= BROADCAST
    return keyed.join(F.broadcast(table) if few else table, ["width", "bits", "key"]).select("host", "block", "bits")


def with_block(df: DataFrame, host: str, ranges: DataFrame, cidr: str, into: str = "block") -> DataFrame:
    """df with the longest block that holds the host (of equal ones the first as text), null if none does."""
    best = blocks_of(df, host, ranges, cidr).groupBy(F.col("host").alias("__host")).agg(F.min_by("block", F.struct(-F.col("bits"), "block")).alias(into))
    return df.join(best, df[host] == best["__host"], "left").drop("__host")


def blocked_ranges(spark) -> DataFrame:
    """The blocks that are never fetched, as a table to add others to."""
    return spark.createDataFrame([(c,) for c in [*fixed.BLOCKED_RANGES, "::/127", "fc00::/7", "fe80::/10"]], "cidr string")


def flag_blocked(df: DataFrame, host: str, ranges: DataFrame, cidr: str = "cidr", scheme: str | None = None) -> DataFrame:
    """blocked: another scheme than http(s), localhost, or an address in one of the ranges; block: which."""
    found = with_block(df, host, ranges, cidr)
    other = ~F.lower(F.col(scheme)).isin("http", "https") if scheme else F.lit(False)
    return found.withColumn("blocked", F.coalesce(other, F.lit(False)) | F.coalesce(bare(F.col(host)) == "localhost", F.lit(False)) | F.col("block").isNotNull())
