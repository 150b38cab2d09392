"""Report wording. Readers of the result tables match on these texts."""

LAYER_TOTAL = "大盘"
LAYER_SPECIAL = "特殊场景"
LAYER_BU = "BU拆分"
LAYER_STRUCTURE = "结构分析"
LAYER_FIRST = "渗透率一级指标"
LAYER_SECOND = "渗透率二级指标"
LAYER_THIRD = "渗透率三级指标"
CONCLUSION = "总结"

TARGETS = {"self_rt": "自有支付占比"}

TEXT_TOTAL = "{target}的预测值为{pred}, 实际值为{actual}, 差值为{gap}"
TEXT_SPECIAL = "特殊场景中，{best}对异动的贡献最大，为{best_ratio}。{explained}。"
TEXT_SPECIAL_WEAK = "但还达不到50%的水平，显然解释力不足，需要继续分析"
TEXT_SPECIAL_STRONG = "特殊场景{elements}对异动的贡献达到{sum}，具有较强的解释力"
TEXT_BU = "从结果看，贡献最大的Top3分别是: {top}。"
TEXT_STRUCTURE = "造成{line}业务占比{trend}的主要维度的元素为: {top}"
TEXT_FIRST = "从{line}业务线的渗透率归因来看，对大盘贡献的Top3为{top}。接下来要分析{next}。"
TEXT_SECOND = (
    "从{line}业务线的{counter}收银台{layer}归因来看，对大盘贡献的Top3为: {top}。"
    "接下来要分析: {next}。"
)
TEXT_THIRD = (
    "拆分{line}业务线的{counter}收银台的{code}指标进行{layer}归因，发现对大盘贡献的Top3为: {top}。"
)

# Pieces of the texts, one per ranked row, and what joins them.
PIECE_INDICATOR = "{element}的{indicator}({value})"
PIECE_FACTOR = "{element}({value})"
PIECE_STRUCTURE = "{element} 的 {dim}({value})"
NEXT_FIRST = "{line}业务{element}的{indicator}"
NEXT_SECOND = "{line}业务{counter}收银台的{element}"
TREND_DOWN, TREND_UP = "下降", "上升"
BETWEEN_PIECES = "、"
BETWEEN_LINES = "；"

# The summary: its paragraphs, and the names of the result rows that hold a text.
SUMMARY_HEAD = "{day} {period} {target}\n异动总结: "
SUMMARY_SPECIAL = "\t·特殊场景: {text}"
SUMMARY_BU = "\t·业务线拆分: {text}"
SUMMARY_STRUCTURE = "\t·结构变化归因: {text}"
SUMMARY_FIRST = "\t·一级渗透率归因: \n{text}"
SUMMARY_SECOND = "\t·二级渗透率归因: \n{text}"
SUMMARY_THIRD = "\t·三级渗透率归因: \n{text}"
BETWEEN_PARAGRAPHS = "\n\n"
INDENT = "\t\t"
PERMEABILITY_MARK = "渗透率"

DIM_LABELS = {
    "platform": "支付平台",
    "new_post_flag": "收银台",
    "paycategory": "支付方式",
}

SECOND_LABELS = {
    "prepay_card_rt": "卡支付比例",
    "prepay_card_p": "卡支付笔单价",
    "prepay_credit_rt": "拿去花支付比例",
    "prepay_credit_p": "拿去花支付笔单价",
    "prepay_other_rt": "其他自有支付比例",
    "prepay_other_p": "其他自有支付笔单价",
    "prepay_orders": "支付成功订单数",
    "prepay_inverse_amt": "1/总体净额",
    "prepay_refunds": "自有退款",
    "quick_new_rt": "新开通标准极速比例",
    "quick_new_self_rt": "新开通且自有支付比例",
    "quick_new_self_p": "新开通标准极速且自有支付笔单价",
    "quick_old_rt": "已开通标准极速比例",
    "quick_old_self_rt": "已开通且自有支付比例",
    "quick_old_self_p": "已开通标准极速且自有支付笔单价",
    "quick_orders": "支付成功订单数",
    "quick_inverse_amt": "1/总体净额",
    "quick_refunds": "自有退款",
    "postpay_new_rt": "新开通后付比例",
    "postpay_new_self_rt": "新开通且自有支付比例",
    "postpay_new_self_p": "新开通后付且自有支付笔单价",
    "postpay_old_rt": "已开通后付比例",
    "postpay_old_self_rt": "已开通且自有支付比例",
    "postpay_old_self_p": "已开通后付且自有支付笔单价",
    "postpay_orders": "支付成功订单数",
    "postpay_inverse_amt": "1/总体净额",
    "postpay_refunds": "自有退款",
}

THIRD_LABELS = {
    "nocard_rt": "进入页无卡比例",
    "havecard_rt": "进入页有卡比例",
    "nocard_bind_rt": "绑卡成功率",
    "nocard_bind_sub_rt": "绑卡后支付提交率",
    "havecard_default_rt": "默勾卡率",
    "havecard_default_sub_rt": "默勾后支付提交率",
    "havecard_change_rt": "换勾卡率",
    "havecard_change_sub_rt": "换勾后支付提交率",
    "havecard_bind_rt": "新绑卡成功率",
    "havecard_bind_sub_rt": "新绑卡后支付提交率",
    "inactive_rt": "进入页拿去花未激活比例",
    "active_rt": "进入页拿去花已激活比例",
    "inactive_sub_rt": "拿去花未激活开通提交率",
    "active_sub_rt": "拿去花已激活勾选提交率",
    "quicknew_haveown_rt": "进入授权页有自有支付工具占比",
    "quicknew_own_sub_rt": "自有支付工具提交率",
}
