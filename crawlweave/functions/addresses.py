"""Private-address tests on textual IP addresses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlweave.functions.text import bind

IPV4 = r"^([0-9]{1,3})\.([0-9]{1,3})\.([0-9]{1,3})\.([0-9]{1,3})$"


def _is_private_v4(a: Column, b: Column, c: Column, d: Column) -> Column:
    return (
        (a == 127)
        | (a == 10)
        | ((a == 169) & (b == 254))
        | ((a == 172) & b.between(16, 31))
        | ((a == 192) & (b == 168))
        | ((a == 0) & (b == 0) & (c == 0) & (d == 0))
    )


def _octets(dotted: Column, test: Callable[..., Column]) -> Column:
    """``test`` of the four numbers of a dotted address; null if one is above 255. The numbers are read once."""
    numbers = F.transform(F.split(dotted, r"\."), lambda x: x.try_cast("int"))
    return bind(numbers, lambda n: F.when(F.array_max(n) <= 255, test(*[F.get(n, i) for i in range(4)])))


def _groups(ip: Column) -> Column:
    """The eight numbers of an IPv6 address; null if it is none. A dotted tail counts as two groups."""
    tail = F.regexp_extract(ip, r"([0-9]{1,3}(?:\.[0-9]{1,3}){3})$", 1)
    hexed = _octets(tail, lambda a, b, c, d: F.concat(F.hex(a * 256 + b), F.lit(":"), F.hex(c * 256 + d)))
    plain = F.when(ip.contains("."), F.concat(F.regexp_replace(ip, r"[0-9]+(?:\.[0-9]+){3}$", ""), hexed)).otherwise(ip)

    def whole(halves: Column) -> Column:
        part = lambda i: F.filter(F.split(F.coalesce(F.get(halves, F.lit(i)), F.lit("")), ":"), lambda g: g != "")

        def filled(parts: Column) -> Column:
            missing = 8 - F.size(parts["head"]) - F.size(parts["rest"])
            filler = F.when((F.size(halves) > 1) & (missing > 0), F.array_repeat(F.lit("0"), missing)).otherwise(F.array().cast("array<string>"))
            return F.when(F.size(halves) <= 2, F.concat(parts["head"], filler, parts["rest"]))

        return bind(F.struct(part(0).alias("head"), part(1).alias("rest")), filled)

    def numbers(groups: Column) -> Column:
        legal = (F.size(groups) == 8) & F.forall(groups, lambda g: g.rlike("^[0-9a-fA-F]{1,4}$"))
        return F.when(legal, F.transform(groups, lambda g: F.conv(g, 16, 10).cast("int")))

    return bind(bind(F.split(plain, "::"), whole), numbers)


def _is_private_v6(ip: Column) -> Column:
    # ::ffff:0:0/96 holds IPv4 addresses; fe80::/10 link-local, fec0::/10 site-local, ::1 loopback, :: any-local
    def test(g: Column) -> Column:
        at = lambda i: F.get(g, F.lit(i))
        leading = F.aggregate(F.slice(g, 1, 5), F.lit(0), lambda a, x: a + x)
        octet = lambda i, shift: F.shiftright(at(i), shift).bitwiseAND(255)
        mapped = (leading == 0) & (at(5) == 0xFFFF)
        zero = (leading == 0) & (at(5) == 0) & (at(6) == 0)
        private = _is_private_v4(octet(6, 8), octet(6, 0), octet(7, 8), octet(7, 0))
        return F.when(mapped, private).otherwise((at(0) >= 0xFE80) & (at(0) <= 0xFEFF) | zero & (at(7) <= 1))

    return bind(_groups(ip), test)


def is_private(address: Column) -> Column:
    """True for loopback, link-local, site-local and any-local addresses; null for no address.

    An IPv4 address mapped into IPv6 is tested as what it is. An octet above 255 is no address.
    """
    bare = F.when(address.rlike(r"[\[\]%]"), F.regexp_replace(address, r"^\[|\]$|%.*$", "")).otherwise(address)

    def test(ip: Column) -> Column:
        return F.when(ip.rlike(IPV4), _octets(ip, _is_private_v4)).when(ip.contains(":"), _is_private_v6(ip))

    return bind(F.lower(bare), test)


def literal_address(host: Column) -> Column:
    """The host itself when it is an address and needs no look-up, else null."""
    return F.when(host.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$") | host.startswith("["), host)
