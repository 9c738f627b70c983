"""Résumé preset: column names, word lists and thresholds.

Fixed values. They define the results, so they are stated as they must be.
"""

# Input columns
GENDER_AGE = "Пол, возраст"
SALARY = "ЗП"
TITLE = "Ищет работу на должность:"
CITY = "Город"
EXPERIENCE = "Опыт работы"
CAR = "Авто"
EDUCATION = "Образование"
SCHOOL = "Образование и ВУЗ"
TRIPS = "Командировки"
TITLE_ALIASES = [TITLE, "Должность", "Position", "Ищет работу на должность", "должность"]

# Feature columns
SALARY_BASE = "ЗП_рубли"
SALARY_NUMBER = "ЗП_число"
AGE = "Возраст"
GENDER = "Пол"
AGE_GROUP = "Возрастная_группа"
CITY_CLEAN = "Город_очищенный"
MONTHS = "Опыт_месяцы"
EXPERIENCE_GROUP = "Опыт_группа"
HAS_CAR = "Есть_авто"
EDUCATION_LEVEL = "Уровень_образования"
TRIP_FREQUENCY = "Частота_командировок"
TITLE_LENGTH = "Длина_названия_должности"
TITLE_FLAG_PREFIX = "Должность_"
YEARS = "Опыт_лет"
EXPERIENCE_DETAIL = "Опыт_группа_детальная"
HIGHER_EDUCATION = "Высшее_образование"
TECHNICAL_EDUCATION = "Техническое_образование"
CAPITAL = "Столица"
CAREER_START = "Начало_карьеры"

NOT_STATED = "Не указано"

# Currency: the first rule with a token in the upper-cased text wins
CURRENCY_RULES = [
    ("USD", ["USD", "$"]),
    ("EUR", ["EUR", "€"]),
    ("KZT", ["KZT", "₸"]),
    ("BYN", ["BYN", "РУБ."]),
    ("RUB", ["RUB", "РУБ", "Р"]),
]
# The published order reads "руб." as Belarusian rubles; this one asks for a Belarusian mark
CORRECTED_CURRENCY_RULES = [
    ("USD", ["USD", "$"]),
    ("EUR", ["EUR", "€"]),
    ("KZT", ["KZT", "₸"]),
    ("BYN", ["BYN", "БЕЛ"]),
    ("RUB", ["RUB", "РУБ", "Р"]),
]
RATES = {"USD": 90.0, "EUR": 100.0, "KZT": 0.2, "BYN": 30.0}

# Units after a number
AGE_UNIT = "год"
YEAR_UNIT = "лет"
MONTH_UNIT = "месяц"

GENDERS = [("Мужчина", ["Мужчина"]), ("Женщина", ["Женщина"])]
AGE_CUTS = [0, 25, 35, 45, 55]
AGE_GROUPS = [NOT_STATED, "18-24", "25-34", "35-44", "45-54", "55+"]
MONTH_CUTS = [0, 12, 36, 60, 120]
MONTH_GROUPS = ["Нет опыта", "До 1 года", "1-3 года", "3-5 лет", "5-10 лет", "Более 10 лет"]
YEAR_EDGES = [0, 1, 3, 5, 10, 20, 100]
YEAR_BINS = ["0-1 год", "1-3 года", "3-5 лет", "5-10 лет", "10-20 лет", "20+ лет"]
CAR_WORDS = ["Имеется"]
EDUCATION_RULES = [
    ("Высшее", ["высшее", "вуз"]),
    ("Среднее специальное", ["среднее", "техникум", "колледж"]),
    ("Неполное высшее", ["неполное"]),
    ("Среднее общее", ["среднее общее", "школа"]),
]
EDUCATION_OTHER = "Другое"
TRIP_RULES = [
    ("Частые", ["готов", "часто", "регулярно"]),
    ("Редкие", ["редко", "иногда"]),
    ("Не готов", ["не готов", "нежелательно"]),
    ("Без командировок", ["не имеет", "без командировок"]),
]
TRIPS_OTHER = "По договоренности"
TITLE_KEYWORDS = ["менеджер", "разработчик", "аналитик", "директор", "специалист", "инженер", "руководитель"]
HIGHER_WORDS = ["высшее"]
TECHNICAL_WORDS = ["техническ", "инженер", "программист", "it", "компьютер"]
CAPITAL_CITIES = ["москва", "санкт-петербург", "минск", "киев", "алматы"]

# Seniority
LEVEL_KEYWORDS = [
    ("junior", ["junior", "младший", "стажер", "trainee", "intern", "джуниор"]),
    ("middle", ["middle", "миддл", "разработчик", "developer", "мидл"]),
    ("senior", ["senior", "сеньор", "ведущий", "старший", "lead", "тимлид"]),
]
LEVEL_YEAR_CUTS = [2, 5]
LEVELS = ["junior", "middle", "senior"]
IT_KEYWORDS = [
    "разработчик", "developer", "программист", "engineer", "data scientist", "data engineer", "devops", "qa",
    "тестировщик", "frontend", "front-end", "backend", "back-end", "fullstack", "full-stack", "ios", "android",
    "mobile", "веб", "web", "software",
]

# Preset thresholds
IMPROVED_SALARY_THRESHOLD = 1_000_000.0
SIMPLE_SALARY_THRESHOLD = 500_000.0
CORRELATION_THRESHOLD = 0.9
MAX_DISTINCT = 5_000
MAX_ONE_HOT = 10
OUTLIER_THRESHOLD = 3.0
