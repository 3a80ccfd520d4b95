"""Enums, keyword tables, weights and seeds that results depend on."""

TYPES = ("LANGUAGE_CENTER", "COURSE_CENTER", "TUTORING", "SCHOOL", "LYCEUM")
STATUSES = ("PENDING", "ACTIVE", "INACTIVE")
DELIVERY_MODES = ("OFFLINE", "HYBRID", "ONLINE")
CATEGORIES = ("LANGUAGES", "SCHOOL_SUBJECTS", "UNIVERSITY_PREP", "KIDS_EDUCATION", "IELTS", "CEFR", "SAT", "IT_COURSES", "PROFESSIONAL_CERTIFICATION")
KNOWN_LANGUAGES = ("uz", "ru", "en", "de")
DEFAULT_CATEGORIES = ("LANGUAGES", "SCHOOL_SUBJECTS", "UNIVERSITY_PREP", "KIDS_EDUCATION")
STATES = ("DISCOVERED", "RESEARCHING", "VERIFIED", "CONTENT_READY", "JSON_READY", "APPROVED", "NEEDS_REVIEW", "REJECTED")
TERMINAL_STATES = ("APPROVED", "NEEDS_REVIEW", "REJECTED")
MAX_RETRIES = 3

#: label -> keywords, in order.
TYPE_KEYWORDS = {
    "SCHOOL": ["maktab", "maktablar", "school", "schools", "школа", "школы", "школ"],
    "LYCEUM": ["litsey", "litseylar", "lyceum", "lyceums", "лицей", "лицеи", "лицея"],
    "LANGUAGE_CENTER": ["til markazi", "til markazlari", "language center", "language centre", "language centers", "language centres", "языковой центр", "языковые центры"],
    "COURSE_CENTER": ["kurs markazi", "kurslar", "kurs", "course center", "course centre", "courses", "course", "курсы", "курс"],
    "TUTORING": ["repetitor", "repetitorlik", "tutoring", "tutor", "репетитор", "репетиторство"],
}
CATEGORY_KEYWORDS = {
    "IELTS": ["ielts"],
    "SCHOOL_SUBJECTS": ["maktab fanlari", "school subjects", "школьные предметы"],
    "UNIVERSITY_PREP": ["universitetga tayyorlov", "universitetga tayyorgarlik", "abituriyent", "abituriyentlar", "university prep", "university entrance", "поступление в университет", "подготовка к поступлению"],
    "KIDS_EDUCATION": ["bolalar rivojlanishi", "bolalar uchun", "bolalar", "kids", "children", "child development", "детск"],
    "LANGUAGES": ["ingliz tili", "chet tili", "chet tillari", "english", "language learning", "tillarni o'rganish", "язык"],
    "CEFR": ["cefr"],
    "SAT": ["sat"],
    "IT_COURSES": ["dasturlash", "it kurs", "it kurslari", "it courses", "programming", "программирован"],
    "PROFESSIONAL_CERTIFICATION": ["sertifikat", "sertifikatlash", "certification", "professional certification", "сертифика"],
}
MEDICAL_KEYWORDS = [
    "clinic", "klinika", "клиника", "hospital", "gospital", "госпиталь", "poliklinika", "поликлиника", "dispanser", "диспансер", "nevrolog", "невролог", "nevrologiya", "неврология", "pediatr", "педиатр", "pediatriya", "педиатрия",
    "psixiatr", "психиатр", "gastroenterolog", "гастроэнтеролог", "endokrinolog", "эндокринолог", "kardiolog", "кардиолог", "tibbiyot markazi", "tibbiy markaz", "медицинский центр", "eeg", "ээг", "электроэнцефалография", "elektroensefalografiya",
]
LANDMARK_KEYWORDS = [
    "jahon merosi", "world heritage", "всемирного наследия", "yunesko", "unesco", "юнеско", "tarixiy yodgorlik", "tarixiy obida", "исторический памятник", "архитектурный памятник", "yodgorlik majmuasi", "arxitektura yodgorligi",
    "muzey-qo'riqxona", "музей-заповедник", "me'moriy ansambl", "архитектурный ансамбль",
]
COURSE_LINK_KEYWORDS = ["kurslar", "kurs", "yo'nalish", "yo‘nalish", "yonalish", "fanlar", "dasturlar", "courses", "course", "programs", "programmes", "курсы", "курс", "направлени", "программы"]
ITEM_KINDS = {"avtomobil": ["avtomobil", "mashina", "avto ", "krossover", "sedan", " mt ", " at "]}
JUNK_ITEM = "(?i)(o['‘’ʻʼ]?quv markaz|filial|tarmog|shahrida|shahridagi|viloyatidagi|eng yaxshi|top\\s*\\d*\\s*(kurs|markaz)|o['‘’ʻʼ]?zbekiston|uzbekistan|узбекистан)"
SOCIAL_HOSTS = r"(instagram\.com|t\.me|telegram\.me|facebook\.com|fb\.com)"
DIRECTORY_HOSTS = r"(kursi24\.uz|yellowpages\.uz|goldenpages\.uz|maps\.|2gis\.|olx\.uz|orgpage|yandex\.[a-z]+/maps)"
#: The number sign is no word character, so a word has to end before it.
SUPERLATIVE = r"(?:(?<![A-Za-z0-9_])(?:best|number\s*1|no\.?\s*1|leading|top-rated|top\s+choice)|(?<=[A-Za-z0-9_])№\s*1)(?![A-Za-z0-9_])"

#: language code -> names.
LANGUAGE_NAMES = {
    "uz": ["uz", "uzb", "uzbek", "uzbekcha", "o'zbek", "ozbek", "o'zbekcha", "ozbekcha", "o'zbek tili", "ozbek tili", "узбекский", "узбек", "узбекский язык"],
    "ru": ["ru", "rus", "russian", "ruscha", "rus tili", "русский", "русский язык"],
    "en": ["en", "eng", "english", "ingliz", "inglizcha", "ingliz tili", "английский", "английский язык", "англ"],
    "de": ["de", "ger", "german", "deutsch", "nemis", "nemis tili", "немецкий", "немецкий язык"],
    "tr": ["tr", "turk", "turkish", "turkcha", "turk tili", "турецкий", "турецкий язык"],
    "ar": ["ar", "arab", "arabic", "arabcha", "arab tili", "арабский", "арабский язык"],
    "zh": ["zh", "chinese", "xitoy", "xitoy tili", "китайский", "китайский язык"],
    "ko": ["ko", "korean", "koreys", "koreys tili", "корейский", "корейский язык"],
    "ja": ["ja", "japanese", "yapon", "yapon tili", "японский", "японский язык"],
    "fr": ["fr", "french", "fransuz", "fransuz tili", "французский", "французский язык"],
    "es": ["es", "spanish", "ispan", "ispan tili", "испанский", "испанский язык"],
    "it": ["it", "italian", "italyan", "italyan tili", "итальянский", "итальянский язык"],
    "fa": ["fa", "persian", "farsi", "fors", "fors tili", "персидский", "персидский язык"],
    "hi": ["hi", "hindi", "hind", "hind tili", "хинди"],
}

#: (cityId, regionId, name, aliases), in order.
CITIES = [
    ("cmrfw8t3y000fn3og703hdh1a", "cmrfw8t2z0000n3ogoka95589", "Tashkent", ["tashkent", "toshkent", "ташкент", "toshkent shahri", "tashkent city"]),
    ("cmrfw8t4w000vn3ogh627i3sh", "cmrfw8t3l0008n3ogkin4zxmr", "Samarkand", ["samarkand", "samarqand", "самарканд", "самарқанд"]),
    ("cmrfw8t4f000ln3ogwe5qmxim", "cmrfw8t390003n3ogz58bus4l", "Bukhara", ["bukhara", "buxoro", "бухара", "бухоро"]),
    ("cmrfw8t4s000tn3ogl0xgaagv", "cmrfw8t3i0007n3og8vo5tly6", "Namangan", ["namangan", "наманган"]),
    ("cmrfw8t550011n3oghyfhzqeu", "cmrfw8t3s000bn3ogfuw7iz5d", "Fergana", ["fergana", "farg'ona", "fargona", "farghona", "фергана", "фарғона"]),
    ("cmrfw8t4b000jn3og6bpxz2ju", "cmrfw8t370002n3og6th4i14j", "Andijan", ["andijan", "andijon", "андижан"]),
    ("cmrfw8t4m000pn3ogzk0v1xj2", "cmrfw8t3d0005n3oggmcfupme", "Karshi", ["karshi", "qarshi", "карши", "kashkadarya", "qashqadaryo"]),
    ("cmrfw8t4j000nn3og8g69mcqv", "cmrfw8t3b0004n3ogjoi7q20r", "Jizzakh", ["jizzax", "jizzakh", "джизак"]),
    (None, "cmrfw8t350001n3ogi0e8d2wc", "Tashkent Region", ["tashkent region", "toshkent viloyati", "toshkent viloyat", "tashkent oblast"]),
]

REQUIRED_FIELDS = ("nameUz", "phone", "city", "address", "type", "categories", "deliveryMode")
BONUS_FIELDS = ("email", "website", "telegram", "instagram", "foundedYear", "studentCount", "teacherCount", "programs", "specializations")
SUBSTANTIVE_FIELDS = ("phone", "address", "website", "email", "telegram", "instagram", "programs", "specializations", "foundedYear", "descriptionSourceText")
MATERIAL_FACTS = ("programs", "specializations", "foundedYear", "address", "studentCount", "teacherCount", "languages", "shifts", "achievements")
SOURCE_BASE = {"website": 0.72, "directory": 0.62, "search": 0.58, "social": 0.55, "fixture": 0.60, "other": 0.50}
BANDS = {"APPROVED": 85, "APPROVED_WITH_WARNINGS": 70, "NEEDS_REVIEW": 50}

OFFER_COLUMNS = {
    "providerName": "Provayder", "productName": "Mahsulot", "category": "Turkum", "website": "Sayt", "phone": "Telefon", "interestRate": "Foiz stavkasi", "loanAmountRange": "Kredit summasi", "loanTermRange": "Muddat", "requirements": "Talablar",
    "description": "Tavsif",
}
LISTING_COLUMNS = {"title": "Nomi", "price": "Narxi", "location": "Manzil", "sourceSite": "Sayt", "sourceUrl": "Havola", "postedDate": "E'lon sanasi", "description": "Tavsif", "attributesText": "Xususiyatlar"}
WEIGHTS = {"sourceConfidence": 0.5, "dataCompleteness": 0.5}
STAGES = ("DISCOVERED", "RESEARCHING", "VERIFIED", "CONTENT_READY", "JSON_READY", "APPROVED")
#: IPv4 ranges that are never fetched.
BLOCKED_RANGES = ["0.0.0.0/8", "10.0.0.0/8", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12", "192.168.0.0/16", "100.64.0.0/10", "224.0.0.0/3"]

# Messages that results hold word for word.
TOO_SHORT = "insufficient source material (descriptionSourceText missing or too short) to generate content"
NO_RUSSIAN = "no nameRu/Russian source material available — descriptionRu left null"
NAMELESS, ABOUT = "Bu ta'lim markazi", " haqida: "
MEDICAL_REASON, LANDMARK_REASON = "looks like a medical organization", "looks like a landmark"
MISSING = {"name": "a name", "place": "a city or address", "kind": "an institution type or category", "facts": "at least 2 substantive facts"}
NO_CITY, BAD_PHONE, NO_NAME = 'could not resolve city "', 'invalid phone "', "no nameUz/nameLatin available"
