"""Word lists, patterns, signatures and weights of the rules.

Everything in this module is data that results depend on.  Rules are regular
expressions in which ``\\s \\S \\w \\d`` stand for the Unicode classes of
:mod:`lexmill.functions.patterns`.
"""

from __future__ import annotations

# --- fixed values: HTML recognition and extraction ---------------------------
HTML_MARKERS = [
    r"<!DOCTYPE\s+html", r"<html", r"<head", r"<body", r"<div", r"<p>", r"<a\s+href",
]
NON_CONTENT_TAGS = ["script", "style", "noscript", "iframe", "head", "footer", "nav"]
TEXT_MEDIA_TYPES = ["text/html", "text/plain", "text/xml", "application/xhtml"]
MIN_PAYLOAD_BYTES = 50
MIN_TEXT_CHARS = 11

# --- fixed values: encodings tried in order ----------------------------------
ENCODINGS = [
    "utf-8", "utf-16", "utf-32",
    "latin-1", "iso-8859-1", "iso-8859-15", "windows-1252", "cp1252",
    "iso-8859-2", "windows-1250", "cp1250",
    "iso-8859-5", "windows-1251", "cp1251", "koi8-r", "koi8-u",
    "iso-8859-7", "windows-1253",
    "iso-8859-9", "windows-1254",
    "iso-8859-8", "windows-1255",
    "iso-8859-6", "windows-1256",
    "gb2312", "gbk", "gb18030", "big5", "big5hkscs",
    "shift_jis", "euc-jp", "iso-2022-jp",
    "euc-kr",
]
GOOD_DECODE_RATIO = 0.05

# --- fixed values: language signatures (character -> percent) ----------------
LANGUAGE_SIGNATURES = {
    "en": {"a": 8.2, "e": 12.7, "i": 7.0, "o": 7.5, "t": 9.1, "h": 6.1, "n": 6.8, "s": 6.3, "r": 6.0},
    "es": {"e": 13.7, "a": 11.5, "o": 8.7, "s": 7.2, "n": 7.0, "r": 6.8, "i": 6.3, "d": 5.9, "l": 5.6},
    "fr": {"e": 14.7, "a": 7.6, "s": 7.9, "i": 7.5, "n": 7.1, "t": 7.2, "r": 6.6, "u": 6.1, "l": 5.5},
    "de": {"e": 16.9, "n": 10.0, "i": 7.6, "s": 7.3, "r": 7.0, "t": 6.1, "a": 6.5, "d": 5.1, "h": 4.8},
    "zh": {"的": 4.0, "一": 1.2, "是": 1.0, "不": 0.9, "了": 0.8, "在": 0.8},
    "ja": {"の": 3.5, "し": 1.2, "る": 1.0, "て": 1.9, "に": 1.8, "と": 1.6},
    "ko": {"이": 4.2, "다": 3.8, "는": 3.2, "의": 2.8, "에": 2.0},
    "ru": {"о": 10.9, "е": 8.5, "а": 8.0, "и": 7.4, "н": 6.3, "т": 5.7},
    "ar": {"ا": 13.1, "ل": 12.2, "ي": 7.5, "و": 6.3, "ن": 6.1, "م": 5.8},
}
# Characters that never count as letters, besides white space.
NON_LETTERS = "0123456789.,!?;:()[]{}\"'`~@#$%^&*_+-=<>|\\/"
# Script ranges that override the signature result, in this order.
SCRIPT_OVERRIDES = {
    "zh": r"[\x{4E00}-\x{9FFF}]",
    "ja": r"[\x{3040}-\x{30FF}]",
    "ko": r"[\x{AC00}-\x{D7A3}]",
    "ar": r"[\x{0600}-\x{06FF}]",
}
SCRIPT_OVERRIDE_MIN = 10
SCRIPT_BONUS = 0.3
CYRILLIC = r"[\x{0400}-\x{04FF}]"
CJK_LANGUAGES = ["zh", "ja", "ko"]

# --- fixed values: boilerplate counted by the quality score ------------------
BOILERPLATE_COMMON = [
    r"copyright", r"all\s+rights\s+reserved", r"powered\s+by", r"terms\s+(of\s+)?(use|service)",
    r"privacy\s+policy", r"contact\s+us", r"follow\s+us", r"share\s+this", r"subscribe\s+to",
    r"newsletter", r"sign\s+up", r"log\s+in", r"register", r"username", r"password",
]
BOILERPLATE_BY_LANGUAGE = {
    "zh": [
        "版权所有", "保留所有权利", "备案号", "ICP", "网站地图", "关于我们", "联系我们", "使用条款",
        "隐私政策", "登录", "注册", "用户名", "密码", "欢迎来到", "关注我们", "点击查看", "上一题",
        "下一题", "目录", "单项选择题", "多项选择题", "判断题", "填空题", "答案", "解析", "在线考试",
        "题库", "首页", "顶部", "底部",
    ],
    "ja": [
        "著作権", "無断転載", "禁止", "利用規約", "プライバシーポリシー", "問い合わせ", "ログイン",
        "新規登録", "ユーザー名", "パスワード", "選択問題", "正しい答え", "解答",
    ],
    "ru": [
        "авторские права", "все права защищены", "политика конфиденциальности",
        "пользовательское соглашение", "вход", "регистрация", "пароль", "контакты", "о сайте", "поиск",
    ],
    "es": [
        "derechos reservados", "política de privacidad", "términos de servicio", "iniciar sesión",
        "registrarse", "contraseña", "contáctenos", "acerca de", "selección múltiple",
        "verdadero o falso", "respuesta correcta",
    ],
    "ar": [
        "جميع الحقوق محفوظة", "حقوق النشر", "سياسة الخصوصية", "شروط الاستخدام", "تسجيل الدخول",
        "اشتراك", "كلمة المرور", "اتصل بنا", "من نحن",
    ],
    "ko": [
        "저작권", "모든 권리 보유", "개인정보 보호정책", "이용약관", "로그인", "회원가입", "비밀번호",
        "문의하기", "회사소개",
    ],
}

# --- fixed values: question and answer-option shapes (multi-line rules) ------
QUESTION_COMMON = [r"^[0-9]+\.\s", r"^Q[0-9]+:", r"^Question\s+[0-9]+"]
CHOICE_COMMON = [r"^[A-D][\s.)\]]+[a-zA-Z]", r"^[0-9]+[).]\s+[A-D][).]\s+"]
QUESTION_BY_LANGUAGE = {
    "zh": [r"^[0-9]+[\s.、：:]+", r"^第[一二三四五六七八九十百千万]+题", r"^题目[\s:：]"],
    "ja": [r"^[0-9]+[\s.、：:]+", r"^問題[0-9]+", r"^第[一二三四五六七八九十]+問"],
    "ru": [r"^[0-9]+[\s.)\]]+", r"^Вопрос\s+[0-9]+", r"^Задание\s+[0-9]+"],
    "es": [r"^[0-9]+[\s.)\]]+", r"^Pregunta\s+[0-9]+", r"^Cuestión\s+[0-9]+"],
    "ar": [r"^[0-9]+[\s.)\]]+", r"^سؤال\s+[0-9]+"],
    "ko": [r"^[0-9]+[\s.)\]]+", r"^문제\s+[0-9]+"],
}
CHOICE_BY_LANGUAGE = {
    "zh": [r"^[ABCD][\s.、：:]+", r"（?[ABCD]）"],
    "ja": [r"^[ABCD][\s.、：:]+", r"(?:[あいうえお])", r"(?:[アイウエオ])"],
    "ru": [r"^[АБВГ][\s.)\]]+", r"^[А-Г][\s.)\]]+"],
    "es": [r"^[ABCD][\s.)\]]+"],
    "ar": [r"^[أبجد][\s.)\]]+", r"^[ابجد][\s.)\]]+"],
    "ko": [r"^[ABCD][\s.)\]]+", r"(?:[가나다라])"],
}

# --- fixed values: weights of the quality score and category thresholds ------
QUALITY_BASE = 0.5
QUALITY_WEIGHTS = {
    "lexical_diversity": 0.25,
    "top5_concentration": -0.10,
    "avg_line_length": 0.05,
    "short_line_ratio": -0.10,
    "long_line_ratio": -0.05,
    "boilerplate_density": -0.20,
    "html_density": -0.10,
    "question_density": -0.05,
    "choice_density": -0.05,
    "exam_content_likelihood": -0.10,
}
QUALITY_THRESHOLDS = {"high": 0.8, "medium": 0.5, "low": 0.3}
FILTER_THRESHOLDS = {
    "min_length": 50, "exam": 0.5, "boilerplate": 0.3, "diversity": 0.3,
    "diversity_min_length": 200, "html": 0.2, "score": 0.3,
}

# --- fixed values: phrases of the issue flags --------------------------------
EXAM_PHRASES = {
    "en": [
        "multiple choice", "true or false", "fill in the blank", "select the correct answer",
        "choose the best answer",
    ],
    "zh": ["单项选择题", "多项选择题", "判断题", "填空题"],
    "ja": ["選択問題", "記述問題", "正しい答え", "解答"],
    "ru": ["выберите правильный ответ", "выберите вариант", "верно или неверно"],
    "es": ["selección múltiple", "verdadero o falso", "llene el espacio en blanco", "elija la respuesta correcta"],
    "ar": ["اختيار من متعدد", "صح أم خطأ", "املأ الفراغ"],
    "ko": ["객관식", "주관식", "맞다 틀리다", "옳은 답"],
}
# The third Spanish phrase mixes Latin and Cyrillic letters; kept as defined.
ISSUE_BOILERPLATE = {
    "common": ["copyright", "all rights reserved", "terms of service", "privacy policy", "login", "register"],
    "zh": ["版权所有", "保留所有权利", "备案号", "ICP", "登录", "注册", "关于我们", "联系我们"],
    "ja": ["著作権", "無断転載", "禁止", "利用規約", "プライバシー", "ログイン", "新規登録"],
    "ru": ["авторские права", "все права защищены", "политика конфиденциальности", "вход", "регистрация"],
    "es": ["derechos reservados", "política de privacidad", "térминos de servicio", "iniciar sesión", "registrarse"],
    "ar": ["حقوق النشر", "جميع الحقوق محفوظة", "سياسة الخصوصية", "تسجيل الدخول", "اشتراك"],
    "ko": ["저작권", "모든 권리 보유", "개인정보 보호정책", "이용약관", "로그인", "회원가입"],
}
FORMATTING_RULES = [r"<[^>]+>", r"&[a-z]+;", r"\[/?[a-z]+\]"]

# --- fixed values: deep cleaning ---------------------------------------------
NOISE_TERMS = ["点击查看答案", "上一题", "下一题", "目录", "登录", "注册", "版权所有"]
# Rules for one stripped line.
BOILERPLATE_LINE_RULES = [
    r"^\s*(Home|Menu|Navigation|首页|菜单|导航)\s*[\|»>]\s*.*$",
    r"^\s*Copyright © \d{4}.*$",
    r"^\s*版权所有.*$",
    r"^\s*All Rights Reserved.*$",
    r"^\s*备案号.*ICP.*$",
    r"^\s*\d+ (comments|评论)$",
    r"^\s*(Share|Tweet|Like|分享).*$",
    r"^\s*(Search|搜索).*$",
    r"^\s*(Username|Password|用户名|密码).*$",
    r"^\s*(Login|Register|登录|注册).*$",
    r"^\s*(上一题|下一题|previous|next).*$",
    r"^\s*点击.*查看答案.*$",
    r"^\s*目录.*$",
    r".*\[\s*\d+\s*\]$",
    r"^[A-D][\s.、:：]+.*$",
    r"^\s*\d+[\s.、:：]+[A-D][\s.、:：]+.*$",
    r"^\s*(单项选择题|多项选择题|判断题).*$",
    r"^\s*(参考答案|正确答案|答案解析).*$",
    r"^\s*\(答案[:：\s]+[A-D]\).*$",
    r"^\s*(网站首页|网站导航|联系我们).*$",
    r"^\s*在线考试题库网.*$",
    r"^\s*欢迎来到.*$",
]
HIGH_BOILERPLATE_RATIO = 0.5
CJK_STEPS = {
    "zh": [
        "点击查看", "上一题|下一题", r"登录\s*[&\s]*注册", r"[ABCD][\s.、:：]+", r"https?://\S+",
        r"\[\d+\]", "单项选择题|多项选择题|判断题", "参考答案|正确答案|答案解析", "在线考试题库网",
        "备案号.*ICP", "欢迎来到.*网站", "关注.*顶部",
    ],
    "ja": ["ログイン|登録"],
    "ko": ["로그인|가입"],
}
LEADING_WELCOME = r"^(欢迎来到|Welcome to|首页|Home page).*?\n"
TRAILING_NOTICE = r"\n.*(版权所有|Copyright|All Rights Reserved).*?$"

# --- fixed values: multilingual pattern filter -------------------------------
# (rule, strong): one strong rule or four weak ones mark a text as boilerplate.
PATTERN_FILTER_BOILERPLATE = [
    (r"copyright|©|\(c\)", True),
    (r"all\s*rights\s*reserved", True),
    (r"powered\s*by", False),
    (r"privacy\s*policy|cookie\s*policy", False),
    (r"terms\s*(of|and)\s*(service|use)", False),
    (r"sign\s*(in|up)|log\s*in|register", False),
    (r"subscribe|newsletter", False),
    (r"contact\s*us|about\s*us", False),
    (r"share\s*this|follow\s*us", False),
    (r"备案号|ICP", True),
    (r"版权所有|保留所有权利", True),
    (r"登录|注册|用户名|密码", False),
    (r"关于我们|联系我们|网站地图", False),
    (r"首页|主页|顶部|底部", False),
    (r"欢迎来到|关注我们|分享", False),
    (r"点击查看|在线考试|题库", True),
    (r"著作権|無断転載|禁止|利用規約", True),
    (r"プライバシー|ポリシー|お問い合わせ", False),
    (r"ログイン|新規登録|パスワード", False),
    (r"авторские права|все права защищены", True),
    (r"вход|регистрация|пароль", False),
    (r"derechos\s*reservados|direitos\s*reservados", True),
    (r"iniciar\s*sesión|registrarse|contraseña", False),
    (r"جميع الحقوق محفوظة|حقوق النشر", True),
    (r"تسجيل الدخول|اشتراك|كلمة المرور", False),
    (r"\d+\s*\/\s*\d+", False),
    (r"<<\s*\d+\s*>>", False),
    (r"\[\s*\d+\s*\]", False),
]
PATTERN_FILTER_WEAK_LIMIT = 4
PATTERN_FILTER_EXAM_ANY_SCRIPT = [r"\(?[A-D]\)?[\s.)\]]+", r"\d+[\s.)\]]+\(?[A-D]\)?"]
PATTERN_FILTER_EXAM = {
    "english": [
        r"multiple[\s-]choice", r"true\s*or\s*false", r"fill[\s-]in[\s-]the[\s-]blank",
        r"answer\s*key|correct\s*answer", r"quiz|exam|test\s*question",
        r"choose\s*the\s*(best|correct)\s*answer",
    ],
    "chinese": ["单项选择题|多项选择题", "判断题|填空题", "正确答案|参考答案|答案解析", "在线考试|题库|试题|考题"],
    "japanese": ["選択問題|記述問題", "正しい答え|解答"],
}
PRIMARY_SCRIPTS = {
    "chinese": r"[\x{4E00}-\x{9FFF}]",
    "japanese": r"[\x{3040}-\x{30FF}]",
    "korean": r"[\x{AC00}-\x{D7A3}]",
    "arabic": r"[\x{0600}-\x{06FF}]",
    "cyrillic": r"[\x{0400}-\x{04FF}]",
}
REMNANT_RULES = [r"</?[a-z]+[^>]*>", r"&[a-z]+;", r"\{\{[^}]+\}\}", r"\[\[(?:[^\]]+\|)?([^\]]+)\]\]"]

# --- fixed values: composite score of the sampled noise analysis -------------
COMPOSITE_WEIGHTS = {
    "text_length": 0.15,
    "regular_reduction": 0.1,
    "deep_reduction": 0.1,
    "sentence_length": 0.2,
    "html_cleanliness": 0.25,
    "noise_level": 0.2,
}

# --- fixed values: languages with a stop-word list ---------------------------
STOP_WORD_LANGUAGES = {
    "en": "english", "es": "spanish", "fr": "french", "de": "german",
    "it": "italian", "pt": "portuguese", "nl": "dutch", "ru": "russian",
}

# --- fixed values: vocabulary and sequences ----------------------------------
PAD, UNK = "<PAD>", "<UNK>"
MAX_VOCABULARY = 10_000
MAX_SEQUENCE = 100
