"""Values that results depend on. They are data, not logic, and are stated here once."""

# ---- fixed values: units, prices and categories ------------------------------------------
TREE_CATEGORIES = ("main", "side", "beverage", "topping", "dessert", "set")
IN_STORE = ("dine_in", "take_away")
WATER_MAX = 20
PAID_BEV_MAX = 40
FREE_ITEM_CODES = ("A13", "H4", "H2")
FREE_NAME_PART = "แลกฟรี"
WATER_ITEM_CODE = "H3"
WATER_DEFAULT_PRICE = "16.05"

# ---- fixed values: option groups ---------------------------------------------------------
SET_MANDATORY_RE = r"(จานที่|แก้วที่|ชามที่|2ที่)"
OPTION_ITEM_GROUPS_RE = r"^(เพิ่มความอร่อย|เพิ่มข้าว|ซุบบ๊วย|ของทอดไซส์ S|เครื่องดื่ม แก้วที่|ไอศครีม 2ที่)"
TOPPING_GROUP_RE = r"(?i)topp|ท็อปปิ้ง|ทอปปิ้ง"
TOPPING_ADD_WORD = "เพิ่ม"
TOPPING_GRAM_WORDS = ("g", "gr", "กรัม")
TOPPING_ALIASES = {"คอหมู": "คอหมูย่าง", "สันคอ": "สันคอหมูย่าง"}

# ---- fixed values: main-dish variants (plain, offal, loaded) -------------------------------
VARIANT_WORDS = ("ธรรมดา", "เครื่องใน", "ทรงเครื่อง")
BASE_VARIANT = "ธรรมดา"
INFO_VARIANT = "เครื่องใน"
TOP_VARIANT = "ทรงเครื่อง"

# ---- fixed values: labels written into result tables ---------------------------------------
NO_PROMO = "ไม่มีโปร"
BUY2GET1_PROMO = "ซื้อ 2 แถม 1 (derived)"
SET_NAME_PREFIXES = ("set", "เซต")
SET_VALUE_METHOD = (
    "in-store bills, last {days} full days; per persons bucket (1/2/3-4/5+, persons = bowls+sets): "
    "net per meal WITH set - WITHOUT set, weighted by set-bill count; "
    "x avg persons per set-bill / avg sets per set-bill; floored at 0"
)
NOTE_NO_TARGET = "no target (sample too small)"
NOTE_AT_TARGET = "already at target"
NOTE_SEPARATOR = " · "
NOTE_BASE = "base = {n} bowls in families with {variant}"
NOTE_OPEN_DAYS = " open weekdays"
PEERLESS = ("rama9",)

# ---- fixed values: delivery-platform exports ------------------------------------------------
ORDER_NUMBER_RE = r"^\s*(?:[Gg][Ff]\s*-?\s*)?(\d{3,4})\s*$"
SPLIT_TAB_PREFIX = "Split"
CATEGORY_NAMES = {"ชำระเงิน": "payment", "การปรับรายได้": "adjustment", "โฆษณา": "ads"}
CANCELLED_STATUS = "ยกเลิก"
UNPAID_STATUS = "เสร็จสมบูรณ์"

COL_DATE = "วันที่"
COL_STORE = "ร้าน"
COL_GROSS = "ยอดขายรวม (฿)"
COL_NET = "ยอดขายสุทธิ (฿)"
COL_ORDERS = "จำนวนรายการชำระเงิน"
COL_AVG = "ยอดชำระเงินเฉลี่ย (฿)"
COL_AVG_RATING = "เรตติ้งเฉลี่ย"
COL_ITEM = "รายการ"
COL_UNITS = "จำนวนที่ขายได้"
COL_ITEM_THB = "ยอดขายที่ทำได้ (฿)"
COL_CAMPAIGN = "โปรโมชัน"
COL_SPEND = "เงินที่ใช้ (฿)"
COL_COMBO = "คอมโบ"
COL_AD_REVENUE = "Ad Generated Sales"
KEY_AD_REVENUE = "sales"  # as feeds and payload call it
COL_REVIEW = "รีวิว"
COL_RATING = "เรตติ้ง"
COL_REPLY = "ตอบกลับ"
COL_SERVICE = "ประเภทบริการ"

# header names that identify each kind of export
SIGNATURES = {
    "turnover": (COL_DATE, COL_STORE, COL_GROSS, COL_ORDERS, COL_AVG_RATING),
    "menu": (COL_DATE, COL_STORE, COL_ITEM, COL_UNITS),
    "combo": (COL_STORE, COL_COMBO),
    "peak": (COL_DATE, COL_STORE, "01", "13", "00"),
    "offers": (COL_DATE, COL_STORE, COL_CAMPAIGN, COL_SPEND),
    "ads_campaign": ("Campaigns Name", "Ad Spend", "Impressions", "Hourly"),
    "keywords": ("Matched Keywords", "Ad Spend", "Impressions"),
    "transactions": ("หมวดหมู่", "ยอดขายสุทธิ", "ทั้งหมด", "Transaction ID"),
    "miwi_store": (COL_STORE, "Missing or Wrong Item Rate (%)"),
    "reviews": (COL_STORE, COL_REVIEW, COL_RATING, "ลูกค้า"),
}
# most specific first
DETECTION_ORDER = ("transactions", "ads_campaign", "keywords", "miwi_store", "menu", "offers",
                   "peak", "turnover", "reviews", "combo")
# zero-based positions in a transactions row (its header repeats names)
TRANSACTION_FIELDS = {
    "store": 2, "created": 5, "category": 7, "status": 9, "transaction": 10, "short_no": 15,
    "booking": 16, "order_type": 18, "gross": 29, "merchant_discount": 35, "net": 40,
    "marketing": 44, "commission_1": 46, "commission_2": 47, "payout": 52,
    "cancel_reason": 59, "cancelled_by": 60,
}
TRANSACTION_MIN_FIELDS = 61

# ---- fixed values: hand-kept inputs ---------------------------------------------------------
# platform store name part -> location
STORE_NAMES = {
    "พระราม 9": "rama9",
    "One City Centre": "occ",
    "Park Silom": "silom",
    "Gaysorn Tower": "gaysorn",
    "sathorn square": "sathorn-square",
    "All Season": "all-seasons",
}
BRANCH_LABELS = {
    "gaysorn": "เกษร",
    "silom": "สีลม",
    "occ": "OCC",
    "sathorn-square": "สาทร",
    "all-seasons": "ออลซีซั่นส์",
    "rama9": "พระราม 9",
}
# location, seats, open hour, close hour, tables, bar seats, stool seats
SEATS = (
    ("rama9", 16, 10, 16, 6, 0, 0),
    ("gaysorn", 54, 10, 20, 27, 0, 0),
    ("occ", 66, 10, 20, 27, 12, 0),
    ("all-seasons", 60, 10, 20, 26, 0, 8),
    ("sathorn-square", 64, 10, 20, 33, 0, 0),
    ("silom", 73, 10, 20, 34, 0, 6),
)
# Thai public holidays of 2026
HOLIDAYS = (
    ("2026-01-01", "วันขึ้นปีใหม่"),
    ("2026-01-02", "วันหยุดพิเศษ (ธปท.)"),
    ("2026-03-03", "วันมาฆบูชา"),
    ("2026-04-06", "วันจักรี"),
    ("2026-04-13", "วันสงกรานต์"),
    ("2026-04-14", "วันสงกรานต์"),
    ("2026-04-15", "วันสงกรานต์"),
    ("2026-05-01", "วันแรงงานแห่งชาติ"),
    ("2026-05-04", "วันฉัตรมงคล"),
    ("2026-05-31", "วันวิสาขบูชา"),
    ("2026-06-01", "วันหยุดชดเชยวันวิสาขบูชา"),
    ("2026-06-03", "วันเฉลิมพระชนมพรรษาสมเด็จพระราชินี"),
    ("2026-07-28", "วันเฉลิมพระชนมพรรษา ร.10"),
    ("2026-07-29", "วันอาสาฬหบูชา"),
    ("2026-08-12", "วันแม่แห่งชาติ"),
    ("2026-10-13", "วันนวมินทรมหาราช"),
    ("2026-10-23", "วันปิยมหาราช"),
    ("2026-12-05", "วันพ่อแห่งชาติ"),
    ("2026-12-07", "วันหยุดชดเชยวันพ่อแห่งชาติ"),
    ("2026-12-10", "วันรัฐธรรมนูญ"),
    ("2026-12-31", "วันสิ้นปี"),
)
