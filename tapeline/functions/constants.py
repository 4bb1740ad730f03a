"""Dictionaries, weights and thresholds that results depend on. All can be overridden by parameter."""

from __future__ import annotations

SOURCES = ("cls", "cninfo", "eastmoney_global", "ndrc")

# Minutes after which a source counts as stale; others use the default.
SOURCE_STALE_MINUTES = {"cls": 30, "eastmoney_global": 60, "cninfo": 180, "ndrc": 480}
DEFAULT_STALE_MINUTES = 240

# Base seconds between collections.
COLLECTION_INTERVALS = {"cls": 300, "eastmoney_global": 600, "cninfo": 1800, "ndrc": 3600}

# Daily snapshot slots and their mode.
SNAPSHOT_SLOTS = (
    ("09:15", "morning"), ("09:20", "morning"), ("09:24", "morning"), ("09:25", "morning"), ("09:30", "morning"),
    ("09:35", "morning"), ("09:45", "morning"), ("14:30", "overnight"), ("14:40", "overnight"), ("14:45", "overnight"),
    ("14:48", "overnight"), ("14:50", "overnight"), ("14:52", "overnight"), ("14:55", "overnight"), ("15:00", "overnight"),
)

# Frames of one snapshot.
FRAMES = (
    "stock_spot", "industry_boards", "concept_boards", "individual_fund_flow_today", "individual_fund_flow_5d",
    "industry_fund_flow_today", "concept_fund_flow_today", "limit_up_pool", "previous_limit_up_pool", "strong_pool",
    "broken_limit_pool", "dtgc_pool",
)

# Title words of the replay's event counters.
POSITIVE_WORDS = ("中标", "订单", "合同", "回购", "增持", "预增", "扭亏", "涨价", "获批", "投产", "突破", "战略合作", "重大进展")
RISK_WORDS = ("减持", "澄清", "监管", "处罚", "立案", "诉讼", "终止", "风险提示", "亏损", "退市", "问询", "异常波动")

# Score base per source.
SOURCE_BASE_SCORE = {"ndrc": 35, "cls": 25, "eastmoney_global": 22, "cninfo": 18}
DEFAULT_BASE_SCORE = 15

# Risk groups.
RISK_KEYWORDS = {
    "share_reduction": ("拟减持", "计划减持", "被动减持", "清仓式减持", "股东减持", "董监高减持", "减持股份"),
    "abnormal_volatility": ("异常波动", "交易异动", "严重异常波动", "风险提示公告", "股票交易风险提示", "非理性炒作", "短期涨幅较大"),
    "clarification": ("澄清公告", "不涉及", "暂不涉及", "未涉及", "无关", "传闻不实", "未开展", "不存在应披露而未披露"),
    "regulatory": ("监管函", "问询函", "关注函", "立案", "被调查", "行政处罚", "纪律处分", "留置"),
    "performance": ("业绩预亏", "业绩下降", "净利润下降", "亏损", "商誉减值", "计提减值"),
    "legal": ("重大诉讼", "仲裁", "司法冻结", "股份冻结", "质押", "司法拍卖"),
    "delisting": ("退市", "*ST", " ST", "终止上市", "退市风险警示"),
    "financing_dilution": ("向特定对象发行股票", "非公开发行股票", "定增", "增发", "摊薄即期回报"),
}
HIGH_RISK_FLAGS = ("share_reduction", "abnormal_volatility", "regulatory", "delisting")
MEDIUM_RISK_FLAGS = ("clarification", "performance", "legal", "financing_dilution")

# Impact groups with their weights, heaviest first.
IMPACT_GROUPS = (
    ("policy", 35, ("国务院", "国家发展改革委", "发改委", "工信部", "商务部", "央行", "证监会", "国家能源局", "财政部",
                    "国家电网", "海关总署", "政策", "通知", "会议", "方案")),
    ("market_confirmation", 30, ("涨停", "跌停", "拉升", "大涨", "大跌", "异动", "封板", "主力资金", "净买入", "净流入",
                                 "成交额", "午评", "复盘")),
    ("industry_catalyst", 25, ("短缺", "供不应求", "涨价", "价格上涨", "订单", "中标", "扩产", "量产", "技术突破", "重大突破",
                               "AI服务器", "数据中心", "液冷", "PCB", "存储", "半导体", "算力")),
    ("global_macro", 20, ("英伟达", "NVIDIA", "台积电", "博通", "美联储", "特朗普", "OPEC", "制裁", "反制", "出口管制")),
    ("company_event", 15, ("回购", "增持", "并购", "收购", "重大资产重组", "投资建设", "对外投资", "战略合作", "重大合同", "股权激励")),
)

# Plates and their keywords.
PLATE_KEYWORDS = {
    "AI": ("AI", "人工智能", "大模型", "ChatGPT", "GPT", "深度学习", "机器学习", "神经网络", "自然语言处理", "NLP",
           "计算机视觉", "语音识别", "图像识别", "智能算法"),
    "算力": ("算力", "GPU", "芯片", "服务器", "数据中心", "云计算", "高性能计算", "HPC", "超算", "计算集群", "算力网络",
             "智算中心", "算力基础设施"),
    "半导体": ("半导体", "芯片", "集成电路", "晶圆", "光刻机", "EDA", "芯片设计", "芯片制造", "封装测试", "晶圆厂", "fab",
               "制程", "工艺", "芯片产业链", "IC"),
    "机器人": ("机器人", "自动化", "工业机器人", "服务机器人", "协作机器人", "机械臂", "AGV", "无人驾驶", "自动驾驶",
               "智能制造", "工业4.0", "智能工厂", "机器人产业"),
}

# Themes of the news summary.
NEWS_THEMES = {
    "AI/算力/数据中心": ("人工智能", "AI", "算力", "数据中心", "服务器", "英伟达", "NVIDIA", "GPU"),
    "CPO/光通信/PCB": ("CPO", "光通信", "光模块", "光纤", "光缆", "PCB", "铜连接", "高速连接"),
    "半导体/芯片": ("半导体", "芯片", "晶圆", "存储", "封测", "光刻", "先进封装", "集成电路"),
    "电力/绿电/能源保供": ("电力", "绿电", "迎峰度夏", "能源保供", "用电", "容量电价", "火电", "水电", "风电", "光伏", "储能"),
    "有色/稀土/钨": ("有色", "稀土", "钨", "铜", "铝", "锂", "金属", "矿"),
    "机器人/智能制造": ("机器人", "智能制造", "工业母机", "自动化", "减速器"),
    "消费/白酒/零售": ("消费", "白酒", "零售", "免税", "食品", "家电", "餐饮"),
    "医药/检测/疫苗": ("医药", "疫苗", "检测", "创新药", "病毒", "流感", "医疗", "生物"),
    "军工/地缘": ("军工", "航天", "导弹", "无人机", "地缘", "战争", "制裁", "反制"),
    "地产/基建": ("地产", "房地产", "基建", "城中村", "保障房", "建筑", "水利"),
    "金融/流动性": ("央行", "降准", "降息", "利率", "汇率", "人民币", "证券", "保险", "银行"),
}
HIGH_IMPACT_WORDS = (
    "国家发展改革委", "发改委", "国务院", "工信部", "商务部", "证监会", "央行", "政策", "通知", "会议", "反制", "制裁",
    "出口管制", "突发", "涨停", "大跌", "异动", "风险提示", "减持", "回购", "中标",
)

# Themes, signal words of the social extractor.
SOCIAL_THEME_PATTERNS = {
    "PCB": "PCB|覆铜板|CCL|电子布|铜箔|玻纤布|高频高速板",
    "半导体材料": "半导体材料|电子特气|特气|六氟化钨|WF6|光刻胶|晶圆|硅片|先进封装",
    "存储/HBM": "存储|HBM|DRAM|NAND|闪存|海力士|三星|内存",
    "AI算力": "算力|AI服务器|数据中心|GPU|英伟达|OpenAI|液冷|光模块|CPO",
    "机器人": "机器人|具身智能|人形机器人|减速器|丝杠|执行器",
    "稀土/小金属": "稀土|小金属|钨|钼|锑|锗|镓|铟|磁材",
    "有色金属": "有色|铜|铝|锌|黄金|白银|贵金属|工业金属",
    "化工/涨价": "化工|涨价|价格上调|供需|产能|库存|环氧|氟化工|磷化工",
    "政策/宏观": "政策|国常会|发改委|央行|利率|汇率|关税|出口|消费",
}
SOCIAL_SIGNAL_WORDS = {
    "hard": ("订单", "中标", "涨价", "供需", "缺口", "产能", "扩产", "政策", "公告", "合同", "业绩", "国产替代"),
    "emotion": ("爆发", "龙头", "起飞", "翻倍", "主线", "最强", "无脑", "梭哈", "必涨", "涨停"),
    "risk": ("风险", "减持", "澄清", "监管", "异动", "高位", "兑现", "退潮", "分歧", "出货"),
}

# Collection keyword lists.
POLICY_KEYWORDS = (
    "AI算力", "半导体芯片", "新能源", "机器人", "数据中心", "数据要素", "低空经济", "数字经济", "新基建", "人工智能", "AI",
    "芯片", "集成电路", "光伏", "风电", "储能", "自动驾驶", "工业机器人", "云计算", "大数据",
)
ANNOUNCEMENT_KEYWORDS = (
    "AI合作", "算力订单", "中标大合同", "回购增持", "并购重组", "战略合作", "GPU", "数据中心", "重大合同", "股权激励", "定增",
    "配股", "业绩预告", "业绩快报",
)

# Columns that carry analysis rather than source facts.
ANALYSIS_COLUMNS = (
    "risk_flags", "risk_reasons", "risk_level", "is_risk_alert", "news_score", "news_tier", "impact_reasons",
    "is_high_impact", "latency_level", "market_score", "next_day_accept_score", "high_open_score", "execution_grade",
    "rotation_risk", "next_day_fund_sources", "high_open_reasons", "requires_news_catalyst", "score_reasons", "risk_notes",
)

# Vendor field code per column (quotes, boards, stock and sector fund flow, local adapter).
SPOT_FIELDS = {
    "code": "f12", "name": "f14", "close": "f2", "pct": "f3", "change": "f4", "volume": "f5", "amount": "f6",
    "amplitude": "f7", "turnover": "f8", "pe": "f9", "volume_ratio": "f10", "high": "f15", "low": "f16", "open": "f17",
    "prev_close": "f18", "total_cap": "f20", "float_cap": "f21", "pb": "f23", "pct_60d": "f24", "pct_ytd": "f25",
    "speed": "f22", "change_5m": "f11", "main_net": "f62",
}
BOARD_FIELDS = {
    "name": "f14", "pct": "f3", "amount": "f6", "turnover": "f8", "rise_count": "f104", "fall_count": "f105",
    "leader": "f128", "leader_pct": "f136", "code": "f12",
}
STOCK_FLOW_FIELDS = {
    "code": "f12", "name": "f14", "pct": "f3", "main_net": "f62", "main_net_pct": "f184", "super_net": "f66", "big_net": "f72",
}
STOCK_FLOW_5D_FIELDS = {
    "code": "f12", "name": "f14", "pct": "f109", "main_net": "f164", "main_net_pct": "f165", "super_net": "f166", "big_net": "f168",
}
SECTOR_FLOW_FIELDS = {
    "code": "f12", "name": "f14", "pct": "f3", "main_net": "f62", "main_net_pct": "f184", "super_net": "f66", "big_net": "f72",
}
ADAPTER_FIELDS = {
    "code": "code", "name": "name", "close": "latestPrice", "pct": "changePercent", "change": "change", "volume": "volume",
    "amount": "turnover", "amplitude": "amplitude", "turnover": "turnoverRate", "pe": "pe", "volume_ratio": "volumeRatio",
    "high": "high", "low": "low", "open": "open", "prev_close": "previousClose", "total_cap": "raw.totalMarketCap",
    "float_cap": "raw.circulatingMarketCap", "pb": "pb", "pct_60d": "raw.change60d", "pct_ytd": "raw.changeYtd",
    "speed": "raw.speed", "change_5m": "raw.change5m",
}
VENDOR_FIELDS = {
    "spot": SPOT_FIELDS, "board": BOARD_FIELDS, "stock_flow": STOCK_FLOW_FIELDS, "stock_flow_5d": STOCK_FLOW_5D_FIELDS,
    "sector_flow": SECTOR_FLOW_FIELDS, "adapter": ADAPTER_FIELDS,
}
TEXT_FIELDS = ("code", "name", "leader")
