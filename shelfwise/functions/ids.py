"""Integer ids from external names."""

from pyspark.sql import Column, functions as F

# Ids are the Java string hash (base 31 over UTF-16 units) cut to 28 bits.
HASH_BASE = 31
ID_MASK = 0xFFFFFFF


def string_id(name: Column) -> Column:
    """28-bit id of a name; null for a null name.

    Working modulo 2**28 at each step gives the low bits of the 32-bit hash. Characters beyond
    the basic plane count as their two surrogate units.
    """

    def push(acc, unit):
        return (acc * HASH_BASE + unit).bitwiseAND(F.lit(ID_MASK))

    def step(acc, code):
        beyond = code - 0x10000
        high = F.shiftright(beyond, 10) + 0xD800
        low = beyond.bitwiseAND(F.lit(0x3FF)) + 0xDC00
        return F.when(code < 0x10000, push(acc, code)).otherwise(push(push(acc, high), low))

    codes = F.transform(F.split(name, ""), F.ascii)
    return F.aggregate(codes, F.lit(0).cast("long"), step).cast("int")
