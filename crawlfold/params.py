"""Thresholds shared by every operator, in one object instead of scattered literals."""

from __future__ import annotations

from dataclasses import dataclass

# A member is dead at DEATH_N deaths, swept at BAN_N blocks in a row,
# and the pool is kept at POOL_N live members.
DEATH_N = 1
BAN_N = 3
POOL_N = 1

# Lock codes of a shop.
FREE = 0
CLAIMED = 1
FETCHED = 20

# Completeness codes of a shop.
ABSENT = 100
COMPLETE = 200
NO_POSITION = 301
NO_BASICS = 400
NO_BASICS_BUT_POSITION = 499

# Page verdicts.
PAGE_OK = 200
PAGE_BLOCKED = 403


@dataclass(frozen=True)
class PoolParams:
    """Pool thresholds. `pool_n` of 0 means work may go on without a member."""

    death_n: int = DEATH_N
    ban_n: int = BAN_N
    pool_n: int = POOL_N


@dataclass(frozen=True)
class Site:
    """Addresses and notices of the directory whose pages are stored. Set your own.

    A URL is its base followed by the area and cuisine codes, the shop id or the shop name.
    A page is a block notice when its title holds `captcha_title` or one of its buttons
    reads exactly `landing_button`.
    """

    seed_base: str = "http://www.example.com/shanghai/ch10/"
    detail_base: str = "http://www.example.com/shop/"
    search_base: str = "https://www.example.com/search/keyword/1/10_"
    captcha_title: str = "验证"
    landing_button: str = "去首页"


SITE = Site()
