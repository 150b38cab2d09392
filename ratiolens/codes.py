"""Code values found in the fact table, and the period tags built on them.

Operators never test a literal themselves: they take a :class:`Codes` profile,
so the same plan runs over any fact table that uses other spellings.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Codes:
    # granularity tags, also used as the period names of the results
    day: str
    week: str
    month: str
    # paycategory
    high_rate_card: str
    # new_post_flag: the three checkout counters
    prepay: str
    quick: str
    postpay: str
    # paytype
    card: str
    credit_line: str
    other_own: str
    # label_a at the quick and postpay counters
    quick_new: str
    quick_old: str
    post_new: str
    post_old: str
    # label_a of prepaid card orders
    nocard_bind: str
    nocard_nobind: str
    havecard_bind: str
    havecard_default: str
    havecard_change: str
    havecard_other: str
    # label_a of prepaid credit-line orders
    noact_new: str
    noact_other: str
    activated: str
    # elements always listed by the special-scene split, in report order
    channels: tuple[str, ...]
    platforms: tuple[str, ...]

    @property
    def periods(self) -> tuple[str, str, str]:
        return (self.day, self.week, self.month)


# The codes a production fact table carries.
PRODUCTION_CODES = Codes(
    day="日",
    week="周",
    month="月",
    high_rate_card="高费率信用卡",
    prepay="预付",
    quick="极速",
    postpay="后付",
    card="卡",
    credit_line="拿去花",
    other_own="其他自有",
    quick_new="标准极速新开通",
    quick_old="标准极速已开通",
    post_new="后付新开通",
    post_old="后付已开通",
    nocard_bind="无卡新绑卡",
    nocard_nobind="无卡未绑卡",
    havecard_bind="有卡新绑卡",
    havecard_default="有卡默勾卡",
    havecard_change="有卡换勾卡",
    havecard_other="有卡其他",
    noact_new="未激活新激活",
    noact_other="未激活非拿去花支付",
    activated="已激活",
    channels=("汇付", "易宝", "票券"),
    platforms=("微信公众号", "微信小程序", "支付宝小程序", "百度小程序"),
)

# The codes written by sources.order_fact.
ORDER_CODES = Codes(
    day="D",
    week="W",
    month="M",
    high_rate_card="high_rate_card",
    prepay="prepay",
    quick="quick",
    postpay="postpay",
    card="card",
    credit_line="credit_line",
    other_own="other_own",
    quick_new="quick_new",
    quick_old="quick_old",
    post_new="post_new",
    post_old="post_old",
    nocard_bind="nocard_bind",
    nocard_nobind="nocard_nobind",
    havecard_bind="havecard_bind",
    havecard_default="havecard_default",
    havecard_change="havecard_change",
    havecard_other="havecard_other",
    noact_new="noact_new",
    noact_other="noact_other",
    activated="activated",
    channels=("chan_1", "chan_2", "chan_missing"),
    platforms=("1-URGENT", "2-HIGH", "3-MEDIUM", "platform_missing"),
)
