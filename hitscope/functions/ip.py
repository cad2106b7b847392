"""IPv4 expressions, all JVM-side and whole-stage-codegen friendly.

``is_ip_address`` (G1) and ``ip_to_long`` (G2) keep the reference's quirks on purpose:
octets are not range-checked, a trailing ``.`` is ignored (Java ``split`` drops trailing
empty parts) and anything not a 4-part signed decimal gives -1. ``cidr_start``/``cidr_end``
(G4) accept canonical IPv4 CIDR or a bare address (= /32), mask host bits, and return -1
for anything else (IPv6, junk, NULL).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The dotted-quad test, as in the reference (octets not range-checked).
DOTTED_QUAD = r"^(\d{1,3})\.(\d{1,3})\.(\d{1,3})\.(\d{1,3})$"
# Exactly four dot-separated decimal parts that Java's Long.parseLong accepts.
FOUR_SIGNED_DECIMALS = r"^[+-]?[0-9]+\.[+-]?[0-9]+\.[+-]?[0-9]+\.[+-]?[0-9]+\z"
# Strict IPv4 octet 0-255 and CIDR prefix 0-32 for network blocks.
OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4_STRICT = rf"^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}\z"
PREFIX = r"^(3[0-2]|[12]?[0-9])\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_ip_address(host: Column | str) -> Column:
    """G1: True when the host looks like a dotted quad; NULL gives False."""
    return F.coalesce(_col(host).rlike(DOTTED_QUAD), F.lit(False))


def _quad_to_long(text: Column) -> Column:
    """Weighted sum of the four dot-separated parts; wraps like the JVM's shift, NULL on
    overflow. One split per row (four ``split_part`` calls cost ~1.5x)."""
    parts = F.split(text, r"\.", -1)
    p = [F.element_at(parts, i + 1).try_cast("long") for i in range(4)]
    total = F.shiftleft(p[0], 24)
    for value, shift in zip(p[1:], (16, 8, 0)):
        total = F.try_add(total, F.shiftleft(value, shift))
    return total


def ip_to_long(ip: Column | str) -> Column:
    """Dotted quad -> long; NULL, wrong part count or non-number -> -1."""
    stripped = F.rtrim(_col(ip), F.lit("."))
    return F.coalesce(F.when(stripped.rlike(FOUR_SIGNED_DECIMALS), _quad_to_long(stripped)),
                      F.lit(-1).cast("long"))


def _cidr_parts(network: Column | str) -> tuple[Column, Column, Column]:
    net = _col(network)
    pieces = F.split(net, "/", -1)
    address = F.element_at(pieces, 1)
    prefix_text = F.when(F.size(pieces) == 1, F.lit("32")).when(F.size(pieces) == 2, F.element_at(pieces, 2))
    valid = net.isNotNull() & address.rlike(IPV4_STRICT) & F.coalesce(prefix_text.rlike(PREFIX), F.lit(False))
    base = _quad_to_long(address)
    block = F.call_function("shiftleft", F.lit(1).cast("long"), F.lit(32) - prefix_text.try_cast("int"))
    return valid, base, block


def cidr_start(network: Column | str) -> Column:
    """First address of the block as a long, -1 when the block is not IPv4 CIDR."""
    valid, base, block = _cidr_parts(network)
    return F.when(valid, base - F.pmod(base, block)).otherwise(F.lit(-1).cast("long"))


def cidr_end(network: Column | str) -> Column:
    """Last address of the block as a long, -1 when the block is not IPv4 CIDR."""
    valid, base, block = _cidr_parts(network)
    return F.when(valid, base - F.pmod(base, block) + block - 1).otherwise(F.lit(-1).cast("long"))
