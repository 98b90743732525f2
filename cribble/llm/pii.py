"""Personal information in free text by a semi-Markov conditional random field.

A line is cut into segments: a span of one type, or anything else. A span is admissible for a type if it has the
type's form and at most LONGEST characters: any beginning and any end of an address, number or mail in some spelling,
and for names each word that begins with a family name, cut after each possible given name, and each pair of
capitalised words. Nothing around a span decides whether it is a candidate. Whole-span features score it: its form,
length, parts and syllables, whether it is cut out of something longer, the word and signs before it, the title or
particle behind it. The probability of a segmentation is the exponential of its score over that of all segmentations
of admissible spans, summed by a forward pass over their ends; the weights maximise the penalised likelihood of
labelled sentences, with expected counts from the forward and the backward pass. The best segmentation decides
boundaries and types together: a longer reading of an address competes with a shorter one, a name with a title left
off with the name alone.

The labelled sentences are made here from frames, word lists and invented values; no text of the corpus is used. There
are TRAIN of them, a documented bound. Frames with the tag "held" are for tests and never trained on.

Null and empty texts hold nothing.
"""

from __future__ import annotations

import math
import random
import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame

TYPES = ("email", "phone", "national_id", "address", "name")
#: Labelled sentences, passes over them, step and weight of the penalty.
TRAIN, PASSES, STEP, PENALTY = 5000, 6, 0.5, 1e-4
#: Characters of the longest span.
LONGEST = 80

# Korean family names, and words for people's roles that stand behind and before names.
SURNAMES = "김 이 박 최 정 강 조 윤 장 임 한 오 서 신 권 황 안 송 류 홍 전 고 문 양 손 배 백 허 유 남 심 노 하 곽 성 차 주 우 구 민 나 진 지 엄 채 원 천 방 공 현 함 변 염 여 추 도 소 석 선 설 마 길 연 위 표 명 기 반 왕 금 옥 육 인 맹 제 모 탁 국 어 은 편".split()
DOUBLE = "남궁 선우 황보 제갈 독고 사공 서문 동방".split()
ROLES = "기자 씨 님 변호사 교사 과장 대표 의원 교수 원장 팀장 부장 사장 이사 선생 선생님 작가 감독 박사 위원 위원장 회장 총장 국장 실장 차장 대리 사원 주임 경위 경사 판사 검사 의사 간호사 양 군".split()
LEADS = "작성자 입금자명 입금자 예금주 신청인 신고인 참고인 담임 대표 담당 담당자 취재 편집 알린 이름 성명 고객명 받는이 보낸이 수신 발신 제보자 기자 글 By by".split()
PARTICLES = "은는이가을를의와과도께에"
# Syllables that are common in given names.
GIVEN = set("가강건겸경결광규균근기나남늘늬다담대덕도동든라람란래린림루름리마명모문미민범벼별병보빈빛상새서석선설성세소솔수숙순슬승시식신아안애연여영예오온용우욱운울원유윤율은인자재정제조종주준중지진찬참창채천철초춘태택하한해향혁현형혜호홍화환훈휘희")
# Frequent nouns and adverbs that begin like a name.
NOUNS = (
    "이용자 이유 이미지 이메일 이사회 이번주 이후 이제 전문가 전화 전체 전국 전자 정보 정부 정치 정책 정기 정도 정원 조사 조사관 조금 조건 조직 조치 주민 주소 주말 주요 주로 주제 고객 고장 고민 고소인 고소장 기관 기업 기록 기사 기준 기간 기자회견 기자단 공지 공개 공식 공공 공장 공동 공원 "
    "방송 방법 방안 방향 방문 신문 신고 신청서 신청 신고자 신규 서비스 서류 서울 서버 문서 문제 문화 문의 문자 안내 안전 안내문 안건 임시 임금 임대 구매자 구청 구입 구역 지역 지난해 지난주 지난달 지난봄 지방 지원 지금 지도 장소 장비 장애 남성 남부 노동자 노력 노인 도시 도서관 도로 도움 마을 마지막 "
    "마감 명단 명령 모임 모두 모든 모집 민원 민간 민감한 배우 배달 백화점 변호사 변경 변화 변동 보고 부모 선거 선택 선생 설명 설명회 설비 성과 성장 성격 소문 소비자 소식 소송 소장 손님 손해 송금 시청 심각 심사 여성 여행 여러 여전히 연구 연락처 연구원 연습 오늘 오래 오후 오전 오히려 온라인 우선 우리 우편 위원회 위치 "
    "위험 유출 유료 유명한 육아 윤리 은행 음악 의견 인터넷 인증 인용문 인사 인근 자료 장관 전시 제품 제보 제안 제도 제작 진술서 진행 진단 진료 차례 차량 차별 천천히 최근 최종 최고 최초 추가 추진 추천 판매자 편리한 편집본 편지 표시 표준 하루 하반기 학생 학교 한국 한편 한글 함께 현재 현장 현금 홍보 황당 허가 허위"
).split()
HEADS = {n[:k] for n in NOUNS for k in (2, 3) if len(n) >= k}

NUM = str.maketrans("０１２３４５６７８９－．＠", "0123456789-.@")
WIDE = re.compile("[０-９－．＠]")
D = "[공영일이삼사오육륙칠팔구]"
_AT = r"(?:\s?@\s?|\s?[(\[]\s?(?:at|골뱅이)\s?[)\]]\s?|골뱅이| at )"
_DOT = r"(?:\.|\s?[(\[]\s?(?:dot|점)\s?[)\]]\s?|점| dot )"
_TAIL = r"(?:번지)?(?:,? ?[0-9]+동)?(?:,? ?[0-9]+층)?(?:,? ?[0-9]+호)?"
_HEAD = r"(?:[가-힣]{2,4}(?:특별자치|특별|광역)?(?:시|도|군) )(?:[가-힣]{1,5}(?:시|군|구) )?(?:[가-힣]{1,5}(?:읍|면) )?"
FORMS = {
    "email": [rf"[A-Za-z0-9][A-Za-z0-9._%+-]*{_AT}[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)+"],
    "phone": [
        r"(?:\+?82[ -]?\(?0?\)?|0)1[016789][-. ]?[0-9]{3,4}[-. ]?[0-9]{4}",
        r"(?:\(0[0-9]{1,2}\) ?|\+82[ -]?[2-6][0-9]?[-. ]|0(?:2|[3-6][0-9]|70|505)[-. )])[0-9]{3,4}[-. ][0-9]{4}",
        rf"{D}{{3}}[-. ]?{D}{{3,4}}[-. ]?{D}{{4}}",
    ],
    "national_id": [r"[0-9]{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12][0-9]|3[01])(?: ?[-–] ?| )?[0-9]{7}"],
    "address": [
        _HEAD + r"[가-힣0-9]{1,8}(?:대로|로|길)(?: ?[0-9]+(?:번)?길)? [0-9]+(?:-[0-9]+)?" + _TAIL,
        _HEAD + r"[가-힣0-9]{1,6}(?:동|리|가) (?:산 ?)?[0-9]+(?:-[0-9]+)?" + _TAIL,
        r"[0-9]{1,5}[A-Z]? (?:[A-Z][a-z]+ ){1,3}(?:Street|Road|Lane|Avenue|Way|Court|Drive|Place|Square|Terrace|Close|Boulevard|Row|Hill|St|Rd|Ave)\b\.?(?:, (?:Apt|Apartment|Unit|Suite|Flat|Room|No)\.? ?[0-9]+[A-Z]?)?",
    ],
}
_FORMS = {t: [re.compile(p) for p in ps] for t, ps in FORMS.items()}
#: What every span of the form has, near its beginning or end: only there are forms tried.
_EVERY = {"email": re.compile(_AT), "phone": re.compile(rf"[0-9]{{3}}|{D}{{3}}"), "national_id": re.compile(r"[0-9]{6}"), "address": re.compile(r"[가-힣] (?:산 ?)?[0-9]|[0-9][A-Z]? [A-Z][a-z]")}
_STARTS = {"email": re.compile(r"(?<![A-Za-z0-9])[A-Za-z0-9]|(?<=[._%+-])[A-Za-z0-9]"), "phone": re.compile(rf"(?<![0-9])[0-9]|[+(]|(?<![가-힣]){D}"), "national_id": re.compile(r"(?<![0-9])[0-9]"), "address": re.compile(r"(?<![가-힣])[가-힣]|(?<![0-9A-Za-z])[0-9]")}
_DIGIT, _SIGN = re.compile("[0-9]"), re.compile("@|at|골뱅이")
_ENDS = re.compile(r"(?<=[0-9])(?![0-9])|(?<=[A-Za-z])(?![A-Za-z])|(?<=[동호층지])")
FAMILY = set(SURNAMES)
RUN = re.compile("(?<![가-힣])[" + "".join(sorted(FAMILY | {d[0] for d in DOUBLE})) + "][가-힣]+")
PAIR = re.compile(r"(?<![A-Za-z])(?=([A-Z][a-z]+ [A-Z][a-z]+)(?![A-Za-z]))")
HANGUL = re.compile(r"[가-힣]+")
_ROLE = re.compile("|".join(sorted(ROLES, key=len, reverse=True)))
_BEFORE = re.compile(r"([가-힣A-Za-z]+)(\s*[/:：]?\s*)\Z")
_AFTER = re.compile(r"(\s*)(?:\(([0-9]{1,3})\)|([가-힣]+)|(\(?[\w.+-]+\s?[@(\[])|(\S)|$)")
#: Characters looked at before and behind a span.
BEFORE, AFTER = 16, 20


def plain(text: str) -> str:
    """The text with wide digits and signs as plain ones, at the same places."""
    return text.translate(NUM) if WIDE.search(text) else text


def numbered(t: str) -> list[tuple[int, int, str]]:
    """All admissible spans of the types that have numbers or signs. t: a line with plain digits and signs."""
    out = set()
    digits = _DIGIT.search(t) is not None
    for kind, every in _EVERY.items():
        if kind == "email" and not _SIGN.search(t) or not digits and kind in ("address", "national_id"):
            continue
        done = -1
        for hit in every.finditer(t):
            # an address begins up to five words before its number, the others within the span
            lo = max(0, hit.start() - (48 if kind in ("address", "email") else 10))
            for s in _STARTS[kind].finditer(t, lo, hit.end()):
                a = s.start()
                if a <= done:
                    continue
                for p in _FORMS[kind]:
                    m = p.match(t, a, min(len(t), a + LONGEST))
                    if not m:
                        continue
                    out.add((a, m.end(), kind))
                    for e in _ENDS.finditer(t, a + 5, m.end()):
                        if e.start() < m.end() and p.fullmatch(t, a, e.start()):
                            out.add((a, e.start(), kind))
                done = a
    return list(out)


def candidates(text: str) -> list[tuple[int, int, str]]:
    """(start, end, type) of all admissible spans of a line, by end."""
    t = plain(text)
    return sorted(numbered(t) + names(t), key=lambda c: (c[1], c[0], c[2]))


def names(t: str) -> list[tuple[int, int, str]]:
    out = []
    for m in RUN.finditer(t):
        a, s = m.start(), m.group()
        for k in (3, 4) if s[:2] in DOUBLE else (2, 3) if s[0] in FAMILY else ():
            if len(s) >= k:
                out.append((a, a + k, "name"))
    return out + [(m.start(), m.start() + len(m.group(1)), "name") for m in PAIR.finditer(t)]


# -- features ----------------------------------------------------------------------------------------------------


def before_kind(before: str) -> str:
    """What stands before a name: a lead word (with particle or sign), or other."""
    m = _BEFORE.search(before, max(0, before.rfind(" ", 0, max(0, len(before.rstrip("/:： \t")) - 1))))
    if not m:
        return "start" if not before.strip() else "sign"
    word, sign = m.group(1), m.group(2).strip()
    if word == "by" and re.search(r"(?:signed|written|reported|edited) by\s$", before, re.I):
        return "by"
    stem = word[:-1] if word[-1] in "은는이가인" and word[:-1] in LEADS else word
    if stem in LEADS:
        return f"{'글' if stem == '글' and sign else 'lead' if stem != '글' else 'other'}{'+' if stem != word else ''}"
    return "latin" if word[0].isascii() else "other" if m.group(2) else "joined"


def after_kind(after: str) -> str:
    """What stands behind a name: an age, a role, a particle, other letters, blanks, a sign, the end."""
    m = _AFTER.match(after)
    gap, age, word, mail, sign = m.groups() if m else ("", None, None, None, None)
    if age:
        return "age" + ("+" if gap else "")
    if word:
        hit = _ROLE.match(word)
        role = hit.group() if hit else ""
        rest = word[len(role) :]
        fits = not rest or rest[0] in PARTICLES or rest[0] == "라" or rest[:2] in ("입니", "였다", "이다", "로", "으로", "라고", "이라", "에게", "께서", "한테", "들은")
        if role and fits and (gap or len(role) <= 2 or not rest):
            return f"role{'1' if len(role) == 1 else ''}{'+' if gap else ''}{'=' if rest[:1] in ('을', '를') else ''}"
        return "word+" if gap else "particle" if word[0] in PARTICLES and len(word) == 1 else "letters"
    return "mail" + ("+" if gap else "") if mail else f"sign{sign if sign in ',·|(.' else ''}{'+' if gap else ''}" if sign else "end"


def form_features(s: str) -> tuple[str, ...]:
    """Features of a name's own letters."""
    if s[0].isascii():
        return ("latin", f"word {s.split()[0]}" if s.split()[0] in ("The", "In", "At", "By", "Not", "Bad", "A", "On", "For") else "words")
    two = s[:2] in DOUBLE
    given = s[2 if two else 1 :]
    ends = s[-1] in "의에된한은는을를로과와서지적고며면던인이가도만"
    return (f"two{two} {len(s)}", f"ends{ends}", f"syllables{sum(x in GIVEN for x in given)} of {len(given)}", f"noun{s in HEADS}", f"noun{s[:2] in HEADS} {len(s)}", f"masked{bool(re.search('[모○*OX]$', given))}", f"role{any(s.endswith(r) for r in ROLES)}")


def features(text: str, c: tuple[int, int, str]) -> list[str]:
    """Features of a whole span: its own form, and what is around it."""
    a, b, kind = c
    s, before, after = text[a:b], text[max(0, a - BEFORE) : a], text[b : b + AFTER]
    if kind == "name":
        x, y, latin = before_kind(before), after_kind(after), s[0].isascii()
        form = form_features(s)
        return [f"name {f}" for f in (*form, f"before {x}", f"after {y}", f"{x}|{y}", f"{latin}|{x}|{y}")] + ([] if latin else [f"name {form[3]}|{y}", f"name {form[0]}|{y}", f"name {form[1]}|{x}|{y}"])
    cut = bool(re.search(r"[A-Za-z0-9._%+@-]$", before)), bool(re.match(r"[A-Za-z0-9*@]|[-.][A-Za-z0-9*]", after))
    f = [kind, f"{kind} long{len(s) > 12}", f"{kind} left{cut[0]}", f"{kind} right{cut[1]}", f"{kind} words{bool(re.match(D, s)) and kind == 'phone'}"]
    if kind == "address":
        more = bool(re.match(r",? ?[0-9]+(?:-[0-9]+)?(?:번지|번길|길|동|층|호)|[0-9A-Za-z-]|번지|번길|길|동|호|층|, (?:Apt|Unit|Suite|Flat|Room|No)", after))
        f += [f"address parts{min(4, len(re.findall('[0-9]+', s)))}", f"address more{more}", f"address joined{bool(re.search('[가-힣] ?$', before)) and before[-1:] != ' '}"]
    else:
        number = re.search(r"(?:번호|ISBN|버전|주소|문서|접속|건|코드|No\.?|#)[는은이가]? ?$", before)
        f += [f"{kind} number{bool(number) and kind != 'email'}", f"{kind} joined{bool(re.search('[가-힣]$', before))}"]
    return f


# -- the field ---------------------------------------------------------------------------------------------------


def scores(text: str, cs: list, weights: dict[str, float]) -> list[float]:
    return [sum(weights.get(x, 0.0) for x in features(text, c)) for c in cs]


def segment(cs: list, score: list[float]) -> list:
    """The non-overlapping spans of the greatest total score; everything else scores 0. cs is sorted by end."""
    ends = [c[1] for c in cs]
    best, pick = [0.0], [None]
    for i, (a, _, _) in enumerate(cs):
        j = bisect_right(ends, a, 0, i)
        take = best[j] + score[i]
        best.append(max(take, best[i]))
        pick.append(j if take > best[i] else None)
    out, i = [], len(cs)
    while i:
        if pick[i] is None:
            i -= 1
        else:
            out.append(cs[i - 1])
            i = pick[i]
    return out[::-1]


def decode(text: str, weights: dict[str, float], found: list | None = None) -> list[tuple[int, int, str]]:
    """The most probable segmentation of a line."""
    cs = candidates(text) if found is None else found
    return segment(cs, scores(text, cs, weights)) if cs else []


def _plus(x: float, y: float) -> float:
    return (x if x > y else y) + math.log1p(math.exp(-abs(x - y)))


def marginals(cs: list, score: list[float]) -> tuple[float, list[float]]:
    """(log partition function, probability of each span) over all segmentations, by forward and backward sums."""
    n = len(cs)
    ends = [c[1] for c in cs]
    prev = [bisect_right(ends, c[0], 0, i) for i, c in enumerate(cs)]
    ahead = [0.0] * (n + 1)
    for i in range(n):
        ahead[i + 1] = _plus(ahead[i], ahead[prev[i]] + score[i])
    # back[k]: sum over what may follow when the first k spans, by end, are decided
    back = [-math.inf] * (n + 1)
    back[n] = 0.0
    for i in range(n - 1, -1, -1):
        # leaving span i out leads from i + 1 to i; taking it leads to prev[i]
        back[i] = back[i + 1] if back[i] == -math.inf else _plus(back[i], back[i + 1])
        back[prev[i]] = back[i + 1] + score[i] if back[prev[i]] == -math.inf else _plus(back[prev[i]], back[i + 1] + score[i])
    # what was added to back[prev[i]] before its own turn is complete there, as prev[i] <= i
    return ahead[n], [math.exp(min(0.0, ahead[prev[i]] + score[i] + back[i + 1] - ahead[n])) for i in range(n)]


def train(rows: list | None = None, passes: int = PASSES) -> dict[str, float]:
    """Weights of greatest penalised likelihood, by adaptive gradient steps."""
    rows = rows or training()
    r = random.Random(7)
    data = []
    for t, gold in rows:
        cs = candidates(t)
        if cs:
            data.append(([features(t, c) for c in cs], cs, [float(c in gold) for c in cs]))
    w: dict[str, float] = {}
    power: dict[str, float] = {}
    for _ in range(passes):
        r.shuffle(data)
        for feats, cs, told in data:
            _, p = marginals(cs, [sum(w.get(x, 0.0) for x in f) for f in feats])
            grad: dict[str, float] = {}
            for f, y, q in zip(feats, told, p):
                if abs(y - q) > 1e-4:
                    for x in f:
                        grad[x] = grad.get(x, 0.0) + y - q
            for x, g in grad.items():
                g -= PENALTY * w.get(x, 0.0)
                power[x] = power.get(x, 1e-6) + g * g
                w[x] = w.get(x, 0.0) + STEP * g / math.sqrt(power[x])
    return {k: round(v, 4) for k, v in w.items()}


# -- labelled sentences --------------------------------------------------------------------------------------------

_GIVEN = "가나다라마바사아자하도로모보소수우주진현민준서연지은영혜원상철호성훈태경미희숙빈찬결슬온람별솔율담해루겸참휘울름린늘빛강율단은"


def _value(r: random.Random, kind: str) -> str:
    pick = r.choice
    d = lambda n: "".join(pick("0123456789") for _ in range(n))
    if kind == "name":
        return (pick(DOUBLE) if r.random() < 0.12 else pick(SURNAMES)) + pick(_GIVEN) + pick(_GIVEN)
    if kind == "latin":
        w = lambda: pick("ABCDEGHJKLMNPRSTW") + "".join(pick("aeiorlnst") for _ in range(r.randint(3, 7)))
        return f"{w()} {w()}"
    if kind == "email":
        at, dot = pick([("@", "."), (" @ ", "."), (" (at) ", "."), ("[at]", "[dot]"), ("골뱅이", "점"), ("@", "."), (" at ", " dot ")])
        tail = pick([["mail"], ["post-box"], ["gate", "co"]])
        return "".join(pick("abcdefghijklmnoprstuvw") for _ in range(r.randint(3, 9))) + pick(["", "_ab", ".cd", "-ef", d(2), d(4)]) + at + dot.join([*tail, pick(["example", "test", "invalid"])])
    if kind == "phone":
        s = pick(["-", " ", ".", ""])
        word = lambda n: "".join(pick("공일이삼사오육칠팔구") for _ in range(n))
        return pick([f"010{s}{d(4)}{s}{d(4)}", f"010{s}{d(4)}{s}{d(4)}", f"(0{pick(['2', '31', '62'])}) {d(3)}-{d(4)}", f"+82 10-{d(4)}-{d(4)}", f"+82-2-{d(3)}-{d(4)}", f"0{pick('345')}1-{d(3)}-{d(4)}", f"공일공{pick('- ')}{word(4)}{pick('- ')}{word(4)}"])
    if kind == "national_id":
        return f"{d(2)}{pick(['01', '05', '09', '12'])}{pick(['03', '17', '28'])}{pick(['-', ' - ', ' ', ''])}{pick('1234')}{d(6)}"
    n = lambda hi: str(r.randint(1, hi))
    w = lambda: pick("가나다라마바사아하") + pick("람담울솔온별빛")
    head = w() + pick(["시", "군"]) + " " + pick([w() + "구 ", w() + "구 ", w() + "읍 ", ""])
    street = pick([w() + "로 ", w() + "대로 ", w() + "길 ", w() + "로 " + n(250) + "번길 "]) + n(300) + pick(["", "-" + n(30)])
    tail = pick(["", "", " " + str(r.randint(101, 120)) + "동 " + n(1900) + "호", ", " + n(1500) + "호", ", " + n(20) + "층", " " + n(19) + "동 " + n(20) + "층 " + n(900) + "호"])
    english = n(400) + " " + pick(["Elm", "Hollow", "Ferncliff", "Old Mill"]) + " " + pick(["Road", "Lane", "Avenue", "Way", "Court", "Street"]) + pick(["", ", Apt " + n(40), ", Unit " + n(9) + "B", ", Flat " + n(9)])
    return pick([head + street + tail, head + street + tail, head + w() + "동 " + n(900) + pick(["", "-" + n(50)]) + pick(["", "번지"]), english])


# Frames: {} is a value, {N} a name of another kind of role, {n} a number of two digits, {w} a frequent word, {r} a role, {l} a lead, {m} a mail address.
FRAMES = {
    "name": [
        "{l}은 {} {r}이다.", "{l}: {}", "{l} {} {r}", "{l} {} {r}가 답했다.", "어제 {} {r}를 만난 뒤 돌아왔다.", "{} {r}는 다르게 본다.", "{w}에서 {} {r}의 강연이 있었다.", "{}({n})이 가게를 열었다.", "이웃 {}({n}) 씨의 말이다.", "{}님께 여쭈었다.", "{}씨가 먼저 손을 들었다.", "{}님의 답을 붙인다.",
        "{l}는 {}, 나머지는 비웠다.", "{l} {}, 나머지는 비웠다.", "글 / {} ({m})", "글/{} {m}", "By {}, 푸른들 - {m}", "[{l} {} · 편집 푸른들 편집부]", "푸른들 {} 기자 {m}", "푸른들 {} 기자", "{} 기자의 글 더 보기", "{} 기자 구독", "{l}으로 {} {r}가 나왔다.", "{l}은 {}였다.", "{l}은 {} 였다.", "{l}가 {}라고 적혀 있다.", "{w} {} {r}", "“{} {r}가 맡았다”는 {w}", "{w} {r}인 {} 씨가 왔다.", "{l} {}씨는 다시 물었다.", "{}, {} 두 {r}가 함께 썼다.",
    ],
    "latin": ["A note was signed by {}, the keeper.", "By {}, Green Field - {m}", "By {}", "푸른들 {} 기자 {m}", "Reported by {}, from the coast.", "It was written by {}, a neighbour.", "{} 기자의 글 더 보기", "{} told the room to wait.", "Green Field {} 기자 {m}", "글 / {} ({m})"],
    "email": ["보낼 곳: {}", "{}로 알려 주면 된다.", "{} 앞으로 쓴다.", "편지는 {} 에서 받는다.", "문의 {} 담당", "Write to {} before noon.", "전자우편({})", "{}(으)로 답했다.", "연락: {} / 팩스 없음"],
    "phone": ["번호는 {}이다.", "{}로 걸면 된다.", "☎ {}", "전화 {} 담당 없음", "{} 로 문자를 남겼다.", "Call {} after six.", "사무실({})", "{}번 앞에서 끊겼다.", "{} 번으로 왔다."],
    "national_id": ["등록번호 {} 라고 쓰여 있다.", "{} 이 그대로 남았다.", "사본에 {} 숫자가 보인다.", "The card reads {} in print.", "생년과 뒷자리 {} 까지 냈다.", "({})"],
    "address": ["사는 곳은 {}이다.", "{}로 배달한다.", "{} 앞 공터에 모였다.", "모이는 곳: {}", "They met at {}, by the gate.", "{}에 가게가 있다.", "주소 {} (약도 참조)", "{} 이라고 적혀 있다."],
    "held name": ["{l}에게 물으니 {} {r}라 한다.", "발표는 {} {r}가 했다.", "{l} / {}", "{}({n})은 고개를 저었다.", "사진·글 {} 기자 {m}", "{} {r}도 같은 뜻을 비쳤다."],
    "held email": ["자료는 {} 편으로 받았다.", "Reach us at {} any day."],
    "held phone": ["급한 일은 {} 쪽으로 알린다.", "Dial {} for help."],
    "held national_id": ["신분 확인란에 {} 라 썼다."],
    "held address": ["물건은 {} 창고에 있다.", "The shop stands at {}, they said."],
}
PLAIN = [
    *["{S}"] * 40, "{x}", "{x} {w}를 옮겼다.", "{w}에서 {x} {w}를 찾았다.", "{x}{p} {w}를 골랐다.", "{w}의 {x} {w}이다.", "{w} | {x} | {w}", "{w} · {x} · {w}", "{x}하자 {w}가 늘었다.", "{w}를 {x}해 {w}로 바꿨다.", "{x}\n", "“{x}” {w}가 늘었다.", "{w}는 {x}했다.", "{w}를 {x}, {w}로 바꿨다.", "{x} {r}를 뽑는다.", "{w}를 {x}해 {r}를 바꿨다.", "{w}에 {x}해 {r}적인 {w}이다.", "{x}{p} {r}를 만났다.", "{x}하는 {r}의 {w}이다.",
    "{w} {r}를 뽑는다.", "{w} {r}가 모였다.", "{w} {w} {r} 모임이다.", "{w}의 {r}는 말이 없다.", "{w}에서 {r}를 불렀다.", "{w}는 {w}를 {w}에 맡겼다.", "{l}은 {w}에 남지 않았다.", "{l} {w}는 그대로다.", "{l} {w}에서 {w}를 찾았다.", "{l}는 {w}의 {w}를 고쳤다.", "{w}적인 {l} {w}이다.", "{w}({n})는 다음 쪽이다.", "{w} ({n}) {w}를 보라.", "({n}) {w}이 맞다.", "{w}인 {w} {r}를 찾았다.",
    "{s}모 씨가 말했다.", "{s}모({n}) 씨와 A씨가 왔다.", "{s} {r}와 {s} {r}가 다퉜다.", "{s}○○ 씨는 떠났다.", "{s}씨가 왔다.", "{w}하고 {w}는 {w}했다.", "{w}보다 {w}를 {w}까지 옮겼다.", "{w}하면서 {w}를 {w}으로 미뤘다.", "{w}를 {r}에게 물었다.", "{w}한 {r}를 바꿨다.", "{w}이 {r}에서 나왔다.", "{w}로 {r}를 도왔다.", "글 {w}의 {w}를 다뤘다.", "글을 쓴 {w}는 없다.", "{w} 글 / {w} 사항", "{w} {r}단이 왔다.", "{w} {r}실을 고쳤다.",
    "뒷자리 {4}-1****** 만 보인다.", "전화 010-****-{4} 형태다.", "판 {1}.{1}.{2} 이다.", "ISBN 979-11-{4}-{3}-4", "문서 {4}-{4}-07호", "주문 {4}-{4} 건", "{3}.{2}.{3}.{2} 에서 왔다.", "모두 {2},{3}건이다.", "{4}년 {2}월 {2}일", "{4}-{2}-{2} {2}:{2}", "@{3} 계정", "{6} 번", "{2}시 {2}구역 {3} 자리", "제{2}로 {3}", "{w}동 {3} 회", "{w}길 {2} 번째",
    "The Hollow Street plan was dropped.", "In Green Field they met.", "By Monday the Green Lane list was full.", "Not Found", "Green Field told its staff.", "A series by Green Field.", "The Elder House, said the note.", "Read next | The Elm Court sale", "{2} Open Days in the Old Hall", "{w} 대표적인 {w}이다.", "{w} 담당 {w}에 알렸다.", "{l} 없는 {w}만 남았다.", "{w} {l}는 {w}이다.", "{w} {w}님께", "{w}씨앗을 심었다.", "{w} 양이 늘었다.", "{w}에 {w}군이 있다.",
]


def _filled(r: random.Random, t: str) -> str:
    extra = ["자료", "사진", "행사", "일정", "계획", "결과", "부분", "가게", "사람", "아이", "누리집", "화면"]
    noun = lambda: r.choice(NOUNS) if r.random() < 0.75 else r.choice(extra)
    some = {"w": noun, "r": lambda: r.choice([x for x in ROLES if len(x) > 1]), "l": lambda: r.choice([x for x in LEADS if len(x) > 1 and x not in ("By", "by")]), "s": lambda: r.choice(SURNAMES), "n": lambda: str(r.randint(18, 88)), "m": lambda: "ab12@mail.example"}
    ends = ["", *"은는이가을를의와과도에로", "하고", "하자", "된", "한", "할", "했다", "하며", "해", "되는", "하기로", "했지만", "에서", "까지", "보다"]
    word = lambda: r.choice([noun, some["x"], some["x"]])() + r.choice(ends)
    some["S"] = lambda: " ".join([some["l"]() + r.choice("은는가를 의") if r.random() < 0.08 else some["r"]() + r.choice(["", "가", "를"]) if r.random() < 0.06 else f"“{word()}" if r.random() < 0.05 else f"{word()} ({r.randint(10, 99)})" if r.random() < 0.05 else word() for _ in range(r.randint(1, 9))]) + r.choice([".", ".", "?", "", "다."])
    # a word that begins like a name, of any syllables
    some["x"] = lambda: r.choice(SURNAMES) + "".join(chr(0xAC00 + r.randrange(19 * 21) * 28 + r.choice([0, 0, 0, 1, 4, 8, 16, 17, 21])) if r.random() < 0.6 else r.choice(_GIVEN) for _ in range(r.randint(1, 3)))
    some["p"] = lambda: r.choice("은는이가을를의와과도에")
    t = re.sub(r"\{([wrlsnmxpS])\}", lambda m: some[m[1]](), t)
    return re.sub(r"\{(\d)\}", lambda m: "".join(r.choice("0123456789") for _ in range(int(m[1]))), t)


def training(n: int = TRAIN, seed: int = 5, held: bool = False) -> list[tuple[str, list]]:
    """n labelled sentences: (text, [(start, end, type)]); with held, from the frames that training never sees."""
    r = random.Random(seed)
    kinds = [k for k in FRAMES if k.startswith("held") == held]
    out = []
    for _ in range(n):
        if r.random() < 0.45:
            out.append((_filled(r, r.choice(PLAIN)), []))
            continue
        kind = r.choice([*kinds, *(k for k in kinds if "name" in k)])
        what = kind.removeprefix("held ")
        parts = _filled(r, r.choice(FRAMES[kind])).split("{}")
        t, gold = parts[0], []
        for p in parts[1:]:
            v = _value(r, what)
            gold.append((len(t), len(t) + len(v), "name" if what == "latin" else what))
            t += v + p
        gold += [(m.start(), m.end(), "email") for m in re.finditer(r"ab12@mail\.example", t)]
        if r.random() < 0.6:
            before = _filled(r, r.choice(PLAIN)) + " "
            t, gold = before + t, [(a + len(before), b + len(before), k) for a, b, k in gold]
        out.append((t, gold))
    return out


_weights: dict = {}


def weights() -> dict[str, float]:
    """The learned weights; some hundred numbers, which travel with the tasks."""
    if not _weights:
        _weights.update(train())
    return _weights


# -- whole texts ---------------------------------------------------------------------------------------------------


class Finder:
    """The field applied to texts, with the parts of a name's score kept by what they depend on."""

    def __init__(self, w: dict[str, float]):
        self.w = w
        self.before: dict = {}
        self.after: dict = {}
        self.form: dict = {}
        self.score: dict = {}
        self.idle: dict = {}
        self.dead: dict = {}
        #: What may stand around a name, as far as any weight knows it, and anything else.
        parts = [k[5:].split("|") for k in w if k.startswith("name ") and k.count("|") == 1]
        self.kinds = {x for x, _ in parts if not x.startswith(("noun", "two", "ends"))} | {"?"}, {y for _, y in parts} | {"?"}

    @staticmethod
    def kept(cache: dict, key, make):
        v = cache.get(key)
        if v is None:
            if len(cache) > 200_000:
                cache.clear()
            v = cache[key] = make(key)
        return v

    def own(self, s: str) -> tuple[tuple, float]:
        form = self.kept(self.form, s, form_features)
        return form, self.kept(self.score, form, lambda f: sum(self.w.get(f"name {x}", 0.0) for x in f))

    def around(self, form: tuple, x: str, y: str) -> float:
        latin = len(form) == 2
        more = () if latin else (f"{form[3]}|{y}", f"{form[0]}|{y}", f"{form[1]}|{x}|{y}")
        return self.kept(self.score, (form, x, y), lambda _: sum(self.w.get(f"name {f}", 0.0) for f in (f"before {x}", f"after {y}", f"{x}|{y}", f"{latin}|{x}|{y}", *more)))

    def never(self, s: str) -> bool:
        """Whether a name of these letters scores nothing, whatever stands around it."""
        form, own = self.own(s)
        return self.kept(self.idle, form, lambda f: own + max(self.around(f, x, y) for x in self.kinds[0] for y in self.kinds[1]) <= 0)

    def name(self, t: str, a: int, b: int) -> float:
        """The score of a name, as scores() gives it."""
        form, own = self.own(t[a:b])
        return own + self.around(form, self.kept(self.before, t[max(0, a - BEFORE) : a], before_kind), self.kept(self.after, t[b : b + AFTER], after_kind))

    def line(self, text: str) -> list[tuple[int, int, str]]:
        t = plain(text)
        # spans that score nothing are in no best segmentation
        good = [(c, v) for c in names(t) if not self.kept(self.dead, text[c[0] : c[1]], self.never) and (v := self.name(text, c[0], c[1])) > 0]
        good += [(c, v) for c in numbered(t) if (v := sum(self.w.get(x, 0.0) for x in features(text, c))) > 0]
        if not good:
            return []
        good.sort(key=lambda g: (g[0][1], g[0][0], g[0][2]))
        return segment([c for c, _ in good], [v for _, v in good])

    def text(self, text: str) -> list[tuple[int, int, str]]:
        """Spans of personal information in a text of any length, by lines."""
        out, at = [], 0
        for line in text.split("\n"):
            if len(line) > 1:
                out += [(a + at, b + at, k) for a, b, k in self.line(line)]
            at += len(line) + 1
        return out


def found_in(text: str, w: dict[str, float]) -> list[tuple[int, int, str]]:
    return Finder(w).text(text)


def find(docs: DataFrame, w: dict[str, float] | None = None) -> DataFrame:
    """(id, pii_type, pii_value), one row per id, type and distinct value. docs: id, content."""
    w = dict(w or weights())

    def run(batches):
        f = Finder(w)
        for batch in batches:
            rows = [(i, k, v) for i, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if x for k, v in dict.fromkeys((k, x[a:b]) for a, b, k in f.text(x))]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.int64()), pa.array([x[1] for x in rows], pa.string()), pa.array([x[2] for x in rows], pa.string())], ["id", "pii_type", "pii_value"])

    return docs.select("id", "content").mapInArrow(run, "id long, pii_type string, pii_value string")


def replaced(text: str, f: Finder) -> str:
    """The text with each span replaced by its type in brackets."""
    out, at = [], 0
    for a, b, k in f.text(text):
        out += [text[at:a], f"[{k.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, w: dict[str, float] | None = None) -> DataFrame:
    """(id, content): the texts with placeholders of types; null stays null. docs: id, content."""
    w = dict(w or weights())

    def run(batches):
        f = Finder(w)
        for batch in batches:
            texts = [None if x is None else replaced(x, f) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "content"])

    return docs.select("id", "content").mapInArrow(run, "id long, content string")
