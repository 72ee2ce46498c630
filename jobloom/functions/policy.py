"""Policy vocabulary. Results depend on these exact patterns, keys and names."""

from __future__ import annotations

# --- fixed values: URL identity -------------------------------------------------------------------------------
TRACKING_QUERY_KEYS = ("ref", "source", "gh_src", "sent", "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "utm_id", "utm_reader")
HOST_TRACKING_QUERY_KEYS = {"hirify.me": ("v",)}
HOST_ALIASES = {"people.andersenlab.com": "people-andersenlab.com"}

# --- fixed values: company aliases ----------------------------------------------------------------------------
COMPANY_ALIASES = {
    "n ix": "n-ix",
    "n i x": "n-ix",
    "nix": "n-ix",
    "n-ix": "n-ix",
    "chisw": "chi software",
    "chi software": "chi software",
    "globallogic": "globallogic",
    "global logic": "globallogic",
    "softserve": "softserve",
    "soft serve": "softserve",
    "sigma": "sigma software",
    "sigma software": "sigma software",
    "onix": "onix systems",
    "onix systems": "onix systems",
    "zone 3000": "zone3000",
    "zone3000": "zone3000",
    "eleks": "eleks",
    "grid dynamics": "grid dynamics",
    "griddynamics": "grid dynamics",
}

# --- fixed values: title patterns (case-insensitive) ------------------------------------------------------------
PLATFORM_ANCHOR = r"(?<![a-z0-9])(ios|swift|swiftui|uikit|objective[\s\-]?c|objc|obj[\s\-]?c|xcode|iphone|ipad|tvos|watchos|visionos|macos|mac\s*os|os\s*x|appkit|cocoa(?:pods|touch)?)(?![a-z0-9])"
EXCLUDED_ROLE = r"(?<![a-z0-9])(qa|sdet|tpm|quality\s+assurance|test(?:ing)?\s+(?:automation|engineer|developer)|automation\s+(?:qa|engineer|tester)|manual\s+qa|mobile\s+automation)(?![a-z0-9])"
BODY_ROLE = r"(?<![a-z0-9а-яіїєґ])(mobile|native|software\s+(?:engineer|developer)|client[\s\-]?side)(?![a-z0-9а-яіїєґ])"
JUNIOR_TITLE = r"(?<![a-z0-9а-яіїєґ])(junior|jr\.?|intern|internship|trainee|стажер|інтерн|джуніор|без\s+(?:досвіду|опыта)|no\s+experience|entry[\s\-]?level)(?![a-z0-9а-яіїєґ])"
SENIORISH_TITLE = r"(?<![a-z0-9а-яіїєґ])(senior|sr\.?|lead|staff|principal|head|architect)(?![a-z0-9а-яіїєґ])"
CORE_TERMS = r"(?<![a-z0-9])(ios|swift|swiftui|uikit|objective[\s\-]?c|objc|obj[\s\-]?c|appkit|cocoa(?:pods|touch)?)(?![a-z0-9])"
CROSS_PLATFORM_TITLE = r"(?:\bios\s*(?:/|&|and)\s*android\b|\bandroid\s*(?:/|&|and)\s*ios\b|\bios\s+(?:developer|engineer)\s+with\s+android\b|\breact\s+native\s+(?:developer|engineer)\b|\b(?:kmm|kotlin\s+multiplatform)\s+(?:developer|engineer)\b|\bflutter\s+(?:developer|engineer)\b)"
KMP_TITLE = r"(?<![a-z0-9])(?:kmp|kmm|kotlin\s+multi[- ]?platform)(?![a-z0-9])"
MOBILE_TITLE = r"(?<![a-z0-9])mobile\s+(?:app(?:lication)?\s+|software\s+)?(?:engineer|developer)(?![a-z0-9])"
OTHER_MOBILE_PLATFORM = r"(?<![a-z0-9])(?:android|flutter|react\s+native|xamarin|unity)(?![a-z0-9])"
NATIVE_TITLE = r"\b(?:ios|swift|swiftui|uikit|iphone|ipad|objective[ -]?c|objc|cocoatouch)\b"
LEVELS = (
    ("principal", r"(?<![a-z])principal(?![a-z])"),
    ("staff", r"(?<![a-z])staff(?![a-z])"),
    ("lead", r"(?<![a-z])(?:lead|head|architect)(?![a-z])"),
    ("senior", r"(?<![a-z])(?:senior|sr\.?)(?![a-z])"),
    ("middle", r"(?<![a-z])(?:middle|mid)(?![a-z])"),
)
TITLE_QUALIFIER = r"\([^)]*\)|\[[^\]]*\]"
TITLE_SENIORITY = r"(?<![a-z0-9])(?:senior|sr\.?|staff|principal|middle|mid)(?![a-z0-9])"
TITLE_DEVELOPER = r"(?<![a-z0-9])developer(?![a-z0-9])"

# --- fixed values: places and work modes (case-insensitive) -----------------------------------------------------
UKRAINE = r"\b(?:ukraine|ukrainian|kyiv|kiev|lviv|kharkiv|kharkov|dnipro|dnepr|odesa|odessa|vinnytsia|vinnitsa|ivano-frankivsk|uzhhorod|chernivtsi|cherkasy|poltava|zaporizhzhia|ternopil|rivne|lutsk|mykolaiv|україн\w*|украин\w*|київ|киев|львів|львов|харків|харьков|дніпро|днепр|одеса|одесса|вінниця|винница|івано-франківськ|ивано-франковск|ужгород|чернівці|черновцы|черкаси|черкассы|полтава|запоріжжя|запорожье|тернопіль|тернополь|рівне|ровно|луцьк|луцк|миколаїв|николаев)\b"
KYIV = r"\b(?:kyiv|kiev|київ|киев)\b"
REMOTE_LOCATION = r"\b(?:remote|remotely|work from home|worldwide|global|anywhere|віддалено|віддалений|дистанційно)\b"
OFFICE_LOCATION = r"\b(?:on[- ]?site|office|hybrid|not remote|no remote)\b"
SCOPE_WORDS = r"\b(?:work|working|from|home|fully|only|in|or)\b"
NEGATED_REMOTE = r"\b(?:not (?:a )?remote|no remote (?:work|option)|remote (?:work )?is not (?:available|offered|supported)|cannot (?:work|be done) remotely)\b"
SCOPE_PUNCTUATION = " ,;/()–-|"

# --- fixed values: work authorization (case-insensitive) ----------------------------------------------------------
AUTHORIZATION_REQUIRED = r"\b(?:authoriz|authoris)\w*\s+to\s+work\b|\beligib\w*\s+to\s+work\b|\bright\s+to\s+work\b|\b(?:valid|existing|current)\s+work\s+(?:permit|visa|authoriz\w+)\b|\bwork\s+(?:permit|visa|authoriz\w+)\b[^.]{0,40}\b(?:required|mandatory)\b|\bcitizenship\b[^.]{0,40}\b(?:required|mandatory)\b|\bmust\s+be\s+(?:an?\s+)?(?:[a-z.]+\s+)?citizens?\b|\bcitizens?\s+(?:only|or\s+permanent\s+residents?)\b|\bpermanent\s+resident\w*\b[^.]{0,30}\b(?:required|only)\b|\bsecurity\s+clearance\b"
AUTHORIZATION_SUPPORT = r"\bsponsorship\s+(?:is\s+)?(?:available|provided|offered)\b|\b(?:visa|work\s+permit|relocation)\b[^.]{0,60}\b(?:sponsor\w*|support|assistance|assist\w*|provided|available|covered|help\w*|package)\b|\bwe\s+(?:sponsor|provide|offer|cover|help|assist)\w*\b[^.]{0,60}\b(?:visa|work\s+permit|relocation|citizenship)\b"
BLOCKERS = (
    (r"\bsecurity\s+clearance\b", "security clearance required"),
    (r"\bcitizens?(?:hip)?\b", "citizenship or permanent residency required"),
    (r"", "local work authorization required"),
)
OPTIONAL_SECTION = r"^(?:nice.to.have|preferred(?: qualifications)?|bonus|desirable)\b"
REQUIRED_SECTION = r"^(?:requirements|qualifications|personal profile|required skills)\b"
NEUTRAL_SECTION = r"^(?:responsibilities|about us|what we offer|benefits)\b"
CLAUSE_SPLIT = r",|\bbut\b|\band(?=\s+\w+\s+(?:is\s+)?(?:preferred|optional))"
OPTIONAL_CLAUSE = r"\b(?:not required|optional|preferred|also acceptable|other languages|nice.to.have|no need)\b"

# --- fixed values: thresholds and formats ---------------------------------------------------------------------------
DEGRADED_RATIO, DEGRADED_MIN_BEST, DEGRADED_EMPTY_RUNS = 0.4, 8, 3
SEARCH_POLICY, LEGACY_SEARCH_POLICY = "ios", "ios+ai"
RETENTION_DAYS, DESCRIPTION_LIMIT = 30, 6000
ZONE, COLLECT_HOURS, KICK_LAG_MINUTES, LATE_ALERT_MINUTES = "Europe/Kyiv", (8, 14), 15, 60
MESSAGE_LIMIT = 4096
MARK_JUNIOR, MARK_CHECK, MARK_OFFICE, MARK_PERMIT, MARK_FLAG = "🌱", "⚠️", "🏢", "🛂", "🇷🇺"

# --- fixed values: address blocks that are not of the open internet, and addresses in them that are
PRIVATE_V4 = ("0.0.0.0/8", "10.0.0.0/8", "100.64.0.0/10", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12", "192.0.0.0/24", "192.0.2.0/24", "192.168.0.0/16", "198.18.0.0/15", "198.51.100.0/24", "203.0.113.0/24", "240.0.0.0/4")
PUBLIC_V4 = ("192.0.0.9", "192.0.0.10")
