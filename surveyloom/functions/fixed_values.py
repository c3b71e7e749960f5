"""Word lists, label maps and thresholds.

These are fixed values: the results of the library depend on them being exactly
these entries in exactly this order.
"""

# --- fixed values: answer cleaning -------------------------------------------------

MISSING_TOKENS = (
    "", " ", "na", "n/a", "nan", "null", "none", "-", "--",
    "缺失", "空", "无", "未知", "不清楚", "拒答",
)

LIKERT_MAP = {
    "非常不同意": 1, "很不同意": 1, "完全不同意": 1,
    "不同意": 2, "比较不同意": 2, "有点不同意": 2,
    "一般": 3, "中立": 3, "不确定": 3,
    "同意": 4, "比较同意": 4, "有点同意": 4,
    "非常同意": 5, "完全同意": 5,
    "非常不满意": 1, "很不满意": 1, "不满意": 2,
    "满意": 4, "比较满意": 4, "非常满意": 5, "完全满意": 5,
    "肯定不会": 1, "很可能不会": 2, "可能不会": 2, "说不清": 3,
    "可能会": 4, "很可能会": 4, "肯定会": 5,
    "是": 1, "否": 0, "yes": 1, "no": 0, "true": 1, "false": 0,
}

TRAILING_NUMBER_TOKENS = ("非常", "同意", "满意", "可能", "分")

# --- fixed values: header patterns, first hit wins ---------------------------------

SEMANTIC_PATTERNS = (
    ("purchase_frequency", ("购买频率", "购买次数", "购买周期", "购买类似产品的频率", "purchase frequency", "buy frequency")),
    ("usage_frequency", ("使用频率", "使用次数", "使用周期", "usage frequency", "use frequency")),
    ("purchase_channel", ("购买渠道", "购买平台", "购买地点", "在哪里买", "purchase channel", "buy channel")),
    ("monthly_spend", ("月均消费", "消费金额", "客单价", "花费", "spend", "expense", "basket size")),
    ("usage_scene", ("使用场景", "消费场景", "使用情境", "usage scene", "occasion")),
    ("psm_too_cheap", ("太便宜", "过于便宜", "too cheap")),
    ("psm_cheap", ("便宜但能接受", "比较便宜", "觉得便宜", "cheap", "bargain")),
    ("psm_expensive", ("贵但能接受", "比较贵", "觉得贵", "expensive")),
    ("psm_too_expensive", ("太贵", "过于昂贵", "too expensive")),
    ("brand_awareness", ("品牌认知", "品牌知晓", "了解这个品牌", "了解该品牌", "awareness", "brand awareness")),
    ("purchase_intention", (
        "购买意愿", "购买意向", "购买可能", "愿意购买", "考虑购买", "购买这个产品", "复购", "推荐意愿", "推荐给",
        "purchase", "buy", "intention", "willingness", "recommend")),
    ("brand_trust", ("品牌信任", "信任品牌", "信任这个品牌", "信赖", "可信", "品牌可靠", "trust", "credibility")),
    ("brand_attitude", ("品牌态度", "喜欢品牌", "品牌好感", "brand attitude", "brand liking")),
    ("product_quality", ("产品质量", "质量", "品质", "耐用", "可靠", "quality", "durable", "reliable")),
    ("price_value", ("价格", "性价比", "划算", "贵", "便宜", "price", "value for money", "affordable")),
    ("perceived_value", ("感知价值", "价值感", "值得", "有价值", "perceived value", "value")),
    ("satisfaction", ("满意度", "满意", "满足", "satisfaction", "satisfied")),
    ("perceived_risk", ("风险", "担心", "顾虑", "不放心", "risk", "concern")),
    ("product_design", ("设计", "外观", "包装", "颜值", "款式", "design", "package", "packaging")),
    ("product_feature", ("功能", "特性", "卖点", "功效", "feature", "function", "benefit")),
    ("service_experience", ("服务", "售后", "客服", "体验", "service", "experience")),
    ("promotion_response", ("促销", "折扣", "优惠", "活动", "promotion", "discount", "coupon")),
    ("channel_convenience", ("渠道", "门店", "电商", "便利", "方便", "channel", "store", "online")),
    ("social_influence", ("朋友", "家人", "社交", "口碑", "达人", "kol", "influencer", "social", "word of mouth")),
    ("category_involvement", ("兴趣", "关注", "熟悉", "参与度", "involvement", "familiarity", "interest")),
    ("age", ("年龄", "age")),
    ("gender", ("性别", "gender", "sex")),
    ("income", ("收入", "月收入", "家庭收入", "income")),
    ("education", ("学历", "教育", "education")),
    ("occupation", ("职业", "工作", "occupation", "job")),
    ("marital_status", ("婚姻", "marital")),
    ("city_tier", ("城市线级", "城市级别", "city tier")),
    ("city", ("城市", "所在城市", "city")),
)

QUESTION_NUMBER_MARKS = ("q", "题", "第")

# --- fixed values: role hints ------------------------------------------------------

ID_TOKENS = ("id", "编号", "openid", "phone", "email")

BASIC_HINTS = (
    "age", "gender", "income", "city", "city_tier", "education", "occupation",
    "marital", "family", "household", "children", "region", "province",
)
BEHAVIOR_HINTS = (
    "frequency", "usage", "purchase_channel", "channel", "monthly_spend", "spend",
    "expense", "scene", "occasion", "loyalty", "membership", "coupon", "promotion",
    "store", "online", "platform",
)
COGNITIVE_HINTS = (
    "awareness", "attitude", "trust", "satisfaction", "risk", "quality", "value",
    "brand", "design", "feature", "involvement", "intention", "preference", "perceived",
)
PRODUCT_HINTS = (
    "product", "quality", "price", "value", "brand", "trust", "design", "feature",
    "service", "promotion", "channel", "package", "perceived", "satisfaction",
    "risk", "attitude",
)
MEDIATOR_HINTS = ("perceived_value", "satisfaction", "trust", "risk", "attitude", "experience")
MODERATOR_HINTS = ("age", "gender", "income", "city", "tier", "involvement", "familiarity", "segment")
OUTCOME_HINTS = ("purchase", "buy", "willingness", "recommend")
PURCHASE_QUESTION_HINTS = (
    "purchase", "buy", "choice", "chosen", "selection", "preference", "interest",
    "attract", "intention", "willingness", "recommend", "repurchase", "frequency",
    "channel", "spend", "expense",
    "购买", "选择", "意愿", "意向", "倾向", "偏好", "兴趣", "吸引", "关注", "了解",
    "复购", "推荐", "频率", "渠道", "消费", "花费",
)

# --- fixed values: choice, price and ranking columns -------------------------------

CHOSEN_COLUMNS = ("chosen", "choice", "selected", "is_chosen", "是否选择")
RATING_COLUMNS = ("profile_rating", "rating", "preference", "preference_score")

PRICE_KEYS = ("too_cheap", "cheap", "expensive", "too_expensive")
PRICE_NEEDLES = {
    "too_cheap": ("psm_too_cheap", "too_cheap", "太便宜"),
    "cheap": ("psm_cheap", "cheap", "便宜"),
    "expensive": ("psm_expensive", "expensive", "贵"),
    "too_expensive": ("psm_too_expensive", "too_expensive", "太贵"),
}
PRICE_GUARDS = {
    "cheap": ("too_cheap", "太便宜"),
    "expensive": ("too_expensive", "太贵"),
}
PRICE_METRICS = (
    ("valid_raw_rows", "Rows with four PSM prices present"),
    ("monotonic_valid_rows", "Rows passing too cheap < cheap < expensive < too expensive"),
    ("monotonic_valid_rate", "PSM monotonicity pass rate"),
    ("OPP_optimal_price_point", "Intersection of too cheap and too expensive curves"),
    ("IPP_indifference_price_point", "Intersection of cheap and expensive curves"),
    ("PMC_lower_acceptable_price", "Lower bound from too cheap and expensive curves"),
    ("PME_upper_acceptable_price", "Upper bound from too expensive and not-expensive curves"),
    ("median_too_cheap_price", "Median too-cheap threshold"),
    ("median_cheap_price", "Median cheap/acceptable threshold"),
    ("median_expensive_price", "Median expensive/still-acceptable threshold"),
    ("median_too_expensive_price", "Median too-expensive threshold"),
    ("OPP_curve_gap", "Residual curve gap at OPP"),
    ("IPP_curve_gap", "Residual curve gap at IPP"),
    ("PMC_curve_gap", "Residual curve gap at PMC"),
    ("PME_curve_gap", "Residual curve gap at PME"),
)

RANK_DIMENSIONS = {
    "health_rank": "健康认知排序",
    "function_rank": "功能认知排序",
    "daily_rank": "适合日常饮用认知排序",
}
BRAND_LABELS = {
    "six_walnut": "六个核桃",
    "tianma_walnut_milk": "天麻核桃乳",
    "lulu_almond": "露露杏仁露",
    "oatly": "Oatly燕麦奶",
    "doubendou_soymilk": "豆本豆豆奶",
    "yeshu_coconut": "椰树椰汁",
}

# --- fixed values: multi-select questions ------------------------------------------

STEM_SEPARATORS = (" - ", "—", "－", "-")
BINARY_VALUE_SETS = (
    ("0", "1"),
    ("0.0", "1.0"),
    ("否", "是"),
    ("no", "yes"),
    ("false", "true"),
)
SELECTED_VALUES = ("1", "1.0", "是", "yes", "true")

# --- fixed values: personas --------------------------------------------------------

NO_HIGH_FEATURES = "无明显高于整体的特征"
NO_LOW_FEATURES = "无明显低于整体的特征"
NO_PROFILE_INFO = "未识别到足够信息"

PERSONA_SUPPORT_TOKENS = ("quality", "value", "brand", "trust", "satisfaction")
PERSONA_LABELS = {
    "advocate": "高转化拥护型",
    "sceptic": "低认同待培育型",
    "risk": "风险顾虑型",
    "potential": "高转化潜力型",
    "brand": "品牌信任驱动型",
    "product": "产品体验驱动型",
    "value": "价值感驱动型",
    "balanced": "综合均衡型",
}
STRATEGY_RULES = (
    (("高转化", "拥护", "高意愿"), "优先转化与口碑扩散，强化复购、会员权益和社交分享触点。"),
    (("风险", "信任", "权威"), "加强权威背书、真实评价和试用保障，降低决策不确定性。"),
    (("价格", "价值", "性价比"), "突出价格梯度、优惠机制和价值感表达，降低首次购买门槛。"),
    (("低认同", "待培育", "疏离"), "以低成本触达和场景教育为主，先提升认知与试用意愿。"),
    (("体验", "品质", "产品"), "强调产品体验、功能差异和品质稳定性，推动从认知到购买转化。"),
)
STRATEGY_DEFAULT = "围绕核心场景进行差异化触达，并结合行为触点持续验证转化效果。"
