"""Word lists, patterns and thresholds that decide results.

Everything in this file is data that has to have exactly these values, in
exactly this order (list order is match priority), for results to be right.
"""

# --- fixed values: words ----------------------------------------------------

UNKNOWN = "未知"
NEGOTIABLE = "面议"
PLACEHOLDER_TITLE = "为你推荐"
INTERNSHIP = "实习"
ANY_DEGREE = "不限"
BATCH_SUFFIX = "届"

# Labels that crawled pages show in the place of a company name.
COMPANY_TAGS = [
    "体验很好", "独角兽企业", "股权激励", "待遇好", "工资高",
    "互联网综合", "通信电子", "信息安全", "平台大", "数据服务",
    "计算机软件", "游戏", "文娱内容", "硬件", "企业服务",
    "移动互联网", "电商", "教育", "金融", "医疗健康", "生活服务",
    "房产家居", "旅游", "社交网络", "分类信息", "物流运输",
    "其它", "高新技术", "上市公司", "外企", "国企", "事业单位",
    "创业公司", "融资", "天使轮", "A轮", "B轮", "C轮", "D轮及以上",
    "不需要融资", "少于15人", "15-50人", "50-150人", "150-500人",
    "500-2000人", "2000人以上", "交通便利", "同事nice",
    "年底双薪", "股票期权", "带薪年假", "绩效奖金", "定期体检",
]

KNOWN_COMPANIES = [
    "字节跳动", "腾讯", "阿里", "百度", "美团", "京东", "快手", "网易",
    "华为", "小米", "滴滴", "拼多多", "携程", "小红书", "bilibili", "哔哩哔哩",
    "得物", "去哪儿", "搜狐", "新浪", "360", "金山", "联想", "vivo", "oppo",
    "荣耀", "大疆", "海康威视", "科大讯飞", "商汤", "旷视", "蔚来", "理想",
    "小鹏", "特斯拉", "宁德时代", "比亚迪", "顺丰", "中国移动", "中国联通",
    "中国电信", "银行", "招商", "平安", "微众", "蚂蚁", "米哈游", "莉莉丝",
    "叠纸", "鹰角", "完美世界", "巨人网络", "吉比特", "游族", "数字马力",
    "神州泰岳", "海能达", "精智达", "群核科技", "同花顺", "深信服", "用友",
    "金蝶", "亚信", "中兴", "中科院", "研究所",
]

# Cities looked for in a description.
DESC_CITIES = [
    "北京", "上海", "广州", "深圳", "杭州", "成都", "武汉", "南京", "西安",
    "郑州", "长沙", "苏州", "天津", "重庆", "合肥", "厦门", "珠海", "大连",
    "青岛", "石家庄", "宁波", "无锡", "福州", "济南", "沈阳", "哈尔滨", "长春",
    "昆明", "南宁", "贵阳", "南昌", "扬州", "东莞", "佛山",
]

# Cities accepted between brackets of a title by the rollups.
TITLE_CITIES = [
    "北京", "上海", "广州", "深圳", "杭州", "南京", "武汉", "成都", "西安",
    "重庆", "苏州", "天津", "合肥", "郑州", "长沙", "青岛", "大连", "厦门",
    "珠海", "东莞", "佛山",
]

DEGREES = ["博士", "硕士", "本科", "专科"]

# Job families in priority order; matched without regard to case.
JOB_FAMILIES = {
    "AI": ["AI", "人工智能", "算法", "深度学习", "机器学习", "NLP", "CV",
           "机器视觉", "大模型", "SLAM", "机载"],
    "后端开发": ["Java", "C++", "Python", "Go", "Golang", "PHP", "Node", "后端",
             "服务器", "高性能计算"],
    "前端开发": ["前端", "JavaScript", "TypeScript", "Vue", "React", "Web"],
    "测试": ["测试", "QA"],
    "运维": ["运维", "SRE", "DevOps"],
    "数据": ["数据分析", "数据挖掘", "数据开发", "大数据", "ETL"],
    "硬件": ["硬件", "嵌入式", "芯片", "集成电路", "FPGA"],
}

# Activity marks joined into active_status by the cleaning step ...
JUST_APPLIED = "刚刚有人投递过"
HR_MARKS = ["HR近期来过", "HR刚刚处理简历"]
ACTIVITY_MARKS = [JUST_APPLIED, *HR_MARKS]
# ... and the two labels the rollups call active.
APPLIED_TODAY = "今天有人投递"
ACTIVE_LABELS = [JUST_APPLIED, APPLIED_TODAY]

TAG_FAVOURITE = "高收藏"
TAG_ACTIVE = "活跃"
TAG_HR_ACTIVE = "HR活跃"
ACTIVITY_YES = "活跃"
ACTIVITY_NO = "非活跃"

RECRUIT_BY_URL = [("school", "校招"), ("intern", "实习"), ("fulltime", "社招")]

# --- fixed values: listing cards ---------------------------------------------

CARD_TITLE_WORDS = [
    "工程师", "开发", "算法", "产品", "运营", "设计", "经理", "专员", "助理",
    "分析师", "架构师", "测试", "运维", "前端", "后端", "全栈", "Java",
    "Python", "C++", "Go", "PHP", "实习",
]
CARD_TITLE_BANNED = ["发布", "HR"]
CARD_COMPANY_WORDS = ["公司", "科技", "有限", "股份", "集团", "企业", "网络", "信息"]
CARD_COMPANY_SUFFIX = "公司"
CARD_NOT_COMPANY_CITIES = [
    "北京", "上海", "广州", "深圳", "杭州", "南京", "成都", "武汉", "西安",
    "苏州", "天津", "重庆", "广东",
]
CARD_NOT_COMPANY_LINES = [
    "助力简历加分", "校招高薪榜", "高校必争榜", "必争榜", "HR刚处理简历",
    "HR今日在线", "投后必反馈", "直达官网",
]
CARD_NOT_COMPANY_PARTS = ["薪资", "元/天", "天/周", "个月", "简历", "榜", "HR"]
CARD_NOT_COMPANY_INDUSTRIES = [
    "互联网", "电商", "企业服务", "游戏", "硬件", "教育", "金融", "芯片",
    "人工智能", "大数据", "高新技术", "音乐",
]
CARD_PAY_PARTS = ["薪资", "元/天", "K", "k", "万", "面议"]
CARD_CITIES = [
    "北京", "上海", "广州", "深圳", "杭州", "南京", "成都", "武汉", "西安",
    "苏州", "天津", "重庆",
]
CARD_DEGREES = ["本科", "硕士", "博士", "专科", "不限"]
CARD_JOB_TYPES = [
    "产品经理", "后端开发", "前端开发", "客户端开发", "算法工程师", "数据开发",
    "测试工程师", "运维工程师", "运营", "视觉设计", "交互设计", "UI设计",
    "机器学习工程师", "深度学习工程师", "NLP工程师", "大数据工程师",
]
CARD_INDUSTRIES = [
    "企业服务", "游戏", "硬件", "互联网", "电商", "教育", "金融", "芯片",
    "人工智能", "音乐", "高新技术",
]
CARD_PEOPLE = "人"
CARD_PEOPLE_RANGE = ["-", "以上"]
CARD_NATURES = [
    "国企", "央企", "私企", "民企", "外企", "合资", "上市公司", "国有企业",
    "事业单位", "政府机关", "创业公司", "独角兽",
]
CARD_YEAR_WORDS = ["毕业不限", "不限年份", "应届生", "往届生"]
CARD_CONVERSION_YES = ["有转正", "可转正", "转正机会", "优秀转正"]
CARD_CONVERSION_NO = ["无转正", "不转正"]
YES, NO = "是", "否"
CARD_BENEFITS = [
    "五险一金", "六险一金", "带薪年假", "年终奖", "餐补", "餐饮补贴", "交通补贴",
    "住房补贴", "加班补贴", "节日福利", "定期体检", "弹性工作", "免费班车",
    "股票期权", "员工旅游", "培训机会", "补充医疗", "商业保险", "零食下午茶",
    "健身房", "团建活动",
]
CARD_SKILLS = [
    "Java", "Python", "C++", "C#", "Go", "Golang", "PHP", "JavaScript",
    "TypeScript", "React", "Vue", "Angular", "Node.js", "Spring", "SpringBoot",
    "Django", "Flask", "MySQL", "PostgreSQL", "MongoDB", "Redis", "Kafka",
    "RabbitMQ", "Docker", "Kubernetes", "K8s", "Linux", "Git", "AWS", "Azure",
    "TensorFlow", "PyTorch", "机器学习", "深度学习", "NLP", "CV", "HTML", "CSS",
    "SQL", "Spark", "Hadoop", "Flink", "Elasticsearch",
]
CARD_PROMO_PARTS = [
    "HR刚处理简历", "HR今日在线", "直达官网", "投后必反馈", "校招高薪榜", "高校必争榜",
]
CARD_INVALID_TITLE_PARTS = [
    "发布职位", "邀约", "助力", "简历加分", "直达官网", "投后必反馈", "高薪榜", "必争榜",
]
CARD_INVALID_TITLES = [
    "北京", "上海", "广州", "深圳", "杭州", "南京", "成都", "武汉", "西安",
    "苏州", "天津", "重庆", "石家庄", "本科", "硕士", "博士", "专科", "不限",
]
CARD_PAY_COMPANIES = ["薪资面议", "200-300元/天", "120-400元/天"]

# --- fixed values: patterns --------------------------------------------------

RE_FAVOURITES = r"([0-9]+)位牛友收藏"
FAVOURITES_MARK = "位牛友收藏"
RE_PAY_WITH_MONTHS = r"([0-9]+)-([0-9]+)K[·.](?:([0-9]+)薪)?"
RE_PAY = r"([0-9]+)-([0-9]+)K"
RE_PAY_ANY_CASE = r"([0-9]+)-([0-9]+)[Kk]"
RE_MONTHS = r"([0-9]+)薪"
RE_PAY_IN_TEXT = r"[0-9]+-[0-9]+K·[0-9]+薪"
RE_TITLE_BRACKET = r"[（(]([^\n]+?)[）)]"
RE_TITLE_CITY = r"[（(]([一-龥]{2,4})[）)]"
RE_TITLE_BATCH = r"(20[0-9][0-9]|[23][0-9])届"
RE_TRAILING_ID = r"/([0-9]+)/?$"
RE_DETAIL_ID = r"/jobs/detail/([0-9]+)"
RE_CARD_YEAR = r"20[0-9]{2}届"
# Any Unicode whitespace, written so that every regex engine reads it the same way.
_GAP = (
    r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
    r"\x{202f}\x{205f}\x{3000}]*"
)
RE_CARD_DAYS = f"([0-9]+){_GAP}天{_GAP}/{_GAP}周"
RE_CARD_TERM = f"(最少|最短|至少)?([0-9]+){_GAP}个月(以上)?"
RE_JOB_CODE = r"J?[0-9]{5,}"

# --- fixed values: thresholds ------------------------------------------------

CLEAN_FAVOURITES_FROM = 10
ROLLUP_FAVOURITES_FROM = 50
DEFAULT_MONTHS = 12
