"""Fixed values of the tag jobs: rule tables, score bands, dictionaries, model settings.

These must keep the listed values for the tags to come out right. A band is
(lowest, highest, score), both ends included; None leaves an end open.
"""

# Level-5 rules as (tag id, rule), per parent tag.
GENDER_RULES = [(5, "1"), (6, "2")]
JOB_RULES = [(8, "1"), (9, "2"), (10, "3"), (11, "4"), (12, "5"), (13, "6")]
AGE_RULES = [
    (15, "19500101-19591231"),
    (16, "19600101-19691231"),
    (17, "19700101-19791231"),
    (18, "19800101-19891231"),
    (19, "19900101-19991231"),
    (20, "20000101-20091231"),
    (21, "20100101-20191231"),
    (22, "20200101-20291231"),
]
CYCLE_RULES = [(24, "0-7"), (25, "8-14"), (26, "15-30"), (27, "31-60"), (28, "61-90")]
PAYMENT_RULES = [
    (30, "alipay"),
    (31, "wxpay"),
    (32, "chinapay"),
    (33, "kjtpay"),
    (34, "cod"),
    (35, "other"),
]
RFM_RULES = [(38, "1"), (39, "2"), (40, "3"), (41, "4"), (42, "5"), (43, "6"), (44, "7")]
RFE_RULES = [(46, "1"), (47, "2"), (48, "3"), (49, "4")]
PSM_RULES = [(51, "1"), (52, "2"), (53, "3"), (54, "4"), (55, "5")]
USG_RULES = [(57, "0"), (58, "1"), (59, "-1")]
NATIONALITY_RULES = [(420, "1")]

# Parent tag (level 4) of each job.
TAG_IDS = {
    "gender": 4,
    "job": 7,
    "age": 14,
    "cycle": 23,
    "payment": 29,
    "rfm": 37,
    "rfe": 45,
    "psm": 50,
    "usg": 56,
    "brand": 60,
    "political": 352,
    "nationality": 419,
}

# Score bands.
RFM_RECENCY = [(1, 3, 5), (4, 6, 4), (7, 9, 3), (10, 15, 2), (16, None, 1)]
RFM_FREQUENCY = [(200, None, 5), (150, 199, 4), (100, 149, 3), (50, 99, 2), (1, 49, 1)]
RFM_MONETARY = [
    (200000, None, 5),
    (100000, 199999, 4),
    (50000, 99999, 3),
    (10000, 49999, 2),
    (None, 9999, 1),
]
RFE_RECENCY = [(0, 15, 5), (16, 30, 4), (31, 45, 3), (46, 60, 2), (61, None, 1)]
RFE_FREQUENCY = [(400, None, 5), (300, 399, 4), (200, 299, 3), (100, 199, 2), (None, 99, 1)]
RFE_ENGAGEMENT = [(250, None, 5), (200, 249, 4), (150, 199, 3), (50, 149, 2), (None, 49, 1)]

# Days by which a job moves "today" back.
CYCLE_SHIFT_DAYS = 30
RFM_SHIFT_DAYS = 90
RFE_SHIFT_DAYS = 80

# Clustering.
KMEANS_MAX_ITER = 10
KMEANS_SEED = 10
RFM_K = 7
RFE_K = 4
PSM_K = 5
IRIS_K = 3
ELBOW_KS = [3, 4, 5, 6, 7, 8, 9, 10, 11]

# Shopping gender: colour and product-type codes, 0 for anything else.
COLOUR_CODES = {
    "银色": 1,
    "香槟金色": 2,
    "黑色": 3,
    "白色": 4,
    "梦境极光【卡其金】": 5,
    "梦境极光【布朗灰】": 6,
    "粉色": 7,
    "金属灰": 8,
    "金色": 9,
    "乐享金": 10,
    "布鲁钢": 11,
    "月光银": 12,
    "时尚光谱【浅金棕】": 13,
    "香槟色": 14,
    "香槟金": 15,
    "灰色": 16,
    "樱花粉": 17,
    "蓝色": 18,
    "金属银": 19,
    "玫瑰金": 20,
}
TYPE_CODES = {
    "4K电视": 9,
    "Haier/海尔冰箱": 10,
    "LED电视": 12,
    "Leader/统帅冰箱": 13,
    "冰吧": 14,
    "冷柜": 15,
    "净水机": 16,
    "前置过滤器": 17,
    "取暖电器": 18,
    "吸尘器/除螨仪": 19,
    "嵌入式厨电": 20,
    "微波炉": 21,
    "挂烫机": 22,
    "料理机": 23,
    "智能电视": 24,
    "波轮洗衣机": 25,
    "滤芯": 26,
    "烟灶套系": 27,
    "烤箱": 28,
    "燃气灶": 29,
    "燃气热水器": 30,
    "电水壶/热水瓶": 31,
    "电热水器": 32,
    "电磁炉": 33,
    "电风扇": 34,
    "电饭煲": 35,
    "破壁机": 36,
    "空气净化器": 37,
}
FEMALE_COLOURS = ["樱花粉", "白色", "香槟色", "香槟金"]
FEMALE_TYPES = ["料理机", "挂烫机", "吸尘器/除螨仪"]
USG_VOTE_SHARE = 0.6
USG_TREE = {"impurity": "gini", "maxDepth": 5, "maxBins": 5}
USG_MAX_CATEGORIES = 3
TRAIN_SHARE = 0.8

# Product preference.
ALS_SETTINGS = {
    "rank": 10,
    "maxIter": 10,
    "alpha": 1.0,
    "regParam": 1.0,
    "implicitPrefs": True,
    "coldStartStrategy": "drop",
}
ALS_TOP_N = 5

# Text formats.
RULE_PAIR_SEPARATOR = "##"
RULE_KEY_SEPARATOR = "="
SOURCE_KEYS = ["inType", "zkHosts", "zkPort", "hbaseTable", "family", "selectFields", "rowKey"]
PRODUCT_URL_PREFIX = "/product/"
PRODUCT_URL_SUFFIX = ".html"
SCHEDULE_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Parts that the rows of a fit on all users are dealt to.
FIT_PARTS = 8
