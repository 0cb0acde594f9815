"""Labels and codes that the reports read and write."""

# Catalogue categories that are not merchandise.
NON_MERCHANDISE = ("辅料", "邮费")

# Purchasing.
DETAIL_ROW = "明细"
OPEN_STATUSES = ("完成", "已确认")
REWORK_TAG = "返修退货"
DEFECT_PATTERN = "次品|返修"
ADJUSTMENT_TAG = "调整单"
EXCLUSIVE_TAGS = (("小晶", "小晶"), ("唯品", "唯专"))  # (text in the remark, tag)
DONE_LABEL = "完结"
OPEN_LABEL = "未完结"
DONE_RATIO = 0.75

# After-sales.
REFUND_ONLY = "仅退款"

# Yes / no labels.
YES = "是"
NO = "否"

# A plus sign as some exports escape it.
ESCAPED_PLUS = "_x002B_"

# Bracketed suffixes of a size text, removed one after another.
BRACKET_PATTERNS = (
    r"\s*\([^)]*\)",
    r"\s*【[^】]*】",
    r"\s*（[^）]*）",
    r"\s*\([^）]*）",
)

# First bracketed group of a listing title.
TITLE_PATTERN = "【([^】]+)】"

# Fixed values: "colour;spec", '.' and '$' know only the newline as a line end.
COLOR_SPEC_PATTERN = r"(?d)^(.*?);(.*)$"

# Texts that stand for a missing launch date.
MISSING_TOKENS = ("", "NaN", "nan", "None")

# Site code -> channel.
SITE_CHANNELS = {
    "WXChannel": "微信",
    "TouTiaoFXG": "头条",
    "KWaiShop": "快手",
    "Xiaohs": "小红书",
    "Pinduoduo": "拼多多",
    "Tmall": "天猫",
    "TaobaoMarket": "淘宝",
    "Kdt": "有赞",
    "BaiduXD": "百度",
    "Jos": "京东",
    "Vipapis": "唯品",
    "DeWu": "得物",
}
UNKNOWN_CHANNEL = "未知"

# Stock age, right-closed bins of months of 30.44 days.
DAYS_PER_MONTH = 30.44
AGE_EDGES = (-1, 6, 12, 18, 24)
AGE_LABELS = ("0-6个月", "7-12个月", "13-18个月", "19-24个月", "24个月以上")
CLASS_TOTAL = "总计"
GRAND_TOTAL = "合计"
CLASS_ORDER = ("服装", "配饰", "鞋子", "美妆", "总计")
BEAUTY = "美妆"

# Columns of the stock export, in order.
STOCK_EXPORT_COLUMNS = (
    "款式编码", "颜色", "规格", "品牌", "商品编码", "名称", "数量",
    "图片地址链接", "订单占有", "仓库待发", "安全库存下限", "安全库存上限",
    "最小备货天数", "最大备货天数", "采购在途数", "销退仓库存", "进货仓库存",
    "虚拟库存", "次品库存", "调拨在途数", "库存锁定", "运营云仓可用数",
    "样衣仓", "办公室版衣仓", "仓库报废仓", "待清洗仓", "可用数", "公有可用数",
)
