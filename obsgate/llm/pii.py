"""Personal data by candidate spans and boosted trees (operator 6, native DataFrame functions only).

Base spans of four kinds (email, ip, card, phone) come from fixed patterns and
checks and always stay. Further spans are added by a classifier: high-recall
generators propose spans that may overlap the base's and one another, features
of format and context describe each, boosted trees score them, and a threshold
per generator, calibrated on examples held out from the boosting, selects.

The trees are boosted on labelled examples of the library, a bounded set built
by rule from formats and contexts: the native feature expressions run over them, the distinct feature rows
(some hundreds) go to the driver, and the trees come back as one SQL expression. Thresholds are calibrated on
formats and contexts that no training example has. Added spans have the base's kinds or ``secret``
(keys, tokens, passwords).
On texts everything is a built-in function of one row: no shuffle, no Python.

Matches of a pattern with their places come from ``split`` and
``regexp_extract_all`` together. Patterns use possessive runs and look-behinds, so
that long runs of digits or letters cost linear time and no deep recursion; they
match exactly what the plain patterns match from left to right.

Defined results: null or empty text: no spans. Places are code points, ends
exclusive. Null ``doc_id`` and repeated rows: each row is searched by itself. Extra
columns are ignored by ``find_pii`` and kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from functools import partial

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
ALL_KINDS = (*KINDS, "secret")  # the last one only of added spans
_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IP_PARTS = rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"

# what proposes added spans, and their kind
GENERATORS = {
    "mail": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?:\x20?(?:@|\(at\)|\[at\]|\{at\})\x20?[A-Za-z0-9-]{1,63}+(?:(?:\.|\x20?(?:\(dot\)|\[dot\]|\{dot\})\x20?|\x20dot\x20|\x20\.\x20)[A-Za-z0-9-]{1,63}+){1,6}|(?:\x20dot\x20[A-Za-z0-9_+-]{1,64}+){0,3}\x20at\x20[A-Za-z0-9-]{1,63}+(?:\x20dot\x20[A-Za-z0-9-]{1,63}+){1,6})",
    "number": r"(?<![A-Za-z0-9.])[+(]?[0-9](?:[().\x20/-]{0,3}+[0-9]){5,22}+(?![A-Za-z0-9])",
    "quad": r"(?<![0-9.])[0-9]{1,3}+(?:\.[0-9]{1,3}+){3}(?![0-9]|\.[0-9])",
    "secret": r"(?<![A-Za-z0-9+/_-])(?=[0-9+/_-]*+[A-Za-z])[A-Za-z0-9+/_-]{16,}+={0,2}+",
    "password": r"(?<=(?:password|passwd|passphrase|Password|PASSWORD|pwd)[\"']?\x20?[:=]\x20?[\"']?)(?![\"'\x20:=])[!-~&&[^\"'<>,;]]{6,}+",
}
_SECRET_WORDS = "token|secret|password|passwd|passphrase|pwd|api_?key|access_?key|private_?key|signing_?key|key|auth|authorization|bearer|credentials?|cookie|session"
FEATURES = {
    "digits": lambda c: F.length(F.regexp_replace(c.t, "[^0-9]", "")),
    "groups": lambda c: F.size(F.split(F.regexp_replace(c.t, "^[^0-9]+|[^0-9]+$", ""), "[^0-9]+", -1)),
    "plus": lambda c: c.t.startswith("+").cast("int"),
    "paren": lambda c: c.t.contains("(").cast("int"),
    "dots": lambda c: F.length(c.t) - F.length(F.replace(c.t, F.lit("."), F.lit(""))),
    "date": lambda c: c.t.rlike(r"^(?:(?:19|20)[0-9]{2}[-/.][0-9]{1,2}[-/.][0-9]{1,2}|[0-9]{1,2}[-/.][0-9]{1,2}[-/.](?:19|20)?[0-9]{2})(?![0-9])").cast("int"),
    "luhn": lambda c: F.when(F.length(F.regexp_replace(c.t, "[^0-9]", "")).between(13, 19), luhn(F.regexp_replace(c.t, "[^0-9]", ""))).otherwise(False).cast("int"),
    "bytes": lambda c: c.t.rlike(IP_PARTS).cast("int"),
    "veiled": lambda c: c.t.rlike(r"[(\[{](?:at|dot)[)\]}]").cast("int"),
    "domain": lambda c: c.t.rlike(r"(?:\.|dot[)\]])\x20?[A-Za-z]{2,12}$").cast("int"),
    "says_phone": lambda c: c.before.rlike(r"(?i)(?:^|[^\p{L}])(?:phone|tel|call|mobile|cell|fax|dial|telefon|telefono|ring)[^\p{L}0-9]{0,6}(?:me |us |at |on |is |no |number |nr ){0,2}[^\p{L}0-9]{0,4}$").cast("int"),
    "says_card": lambda c: c.before.rlike(r"(?i)(?:card|visa|mastercard|amex|credit|debit|karte|tarjeta|carte)[^\p{L}0-9]{0,4}(?:no|number|nr)?[^\p{L}0-9]{0,6}$").cast("int"),
    "says_mail": lambda c: c.before.rlike(r"(?i)(?:mail|contact|write|reach|kontakt|correo|courriel)[^0-9]{0,12}$").cast("int"),
    "says_host": lambda c: c.before.rlike(r"(?i)(?:^|[^\p{L}])(?:ip|host|server|ping|addr|address)[^0-9]{0,8}$").cast("int"),
    "says_other": lambda c: c.before.rlike(r"(?i)(?:^|[^\p{L}])(?:order|version|ver|v|isbn|page|pages|section|chapter|total|price|id|ref|serial|build|release|score|fig|item|part|sku|invoice)[\x20.:#-]*$").cast("int"),
    "spelled": lambda c: c.t.rlike(r"\x20at\x20.*\x20dot\x20").cast("int"),
    "tld": lambda c: c.t.rlike(r"(?i)(?:\.|dot[)\]}]?)\x20?(?:com|org|net|edu|gov|info|biz|io|eu|de|fr|es|uk|us|ch|nl|it|ca|au|jp|br|mx)$").cast("int"),
    "length": lambda c: F.least(F.length(c.t), F.lit(70)),
    "classes": lambda c: c.t.rlike("[a-z]").cast("int") + c.t.rlike("[A-Z]").cast("int") + c.t.rlike("[0-9]").cast("int") + c.t.rlike("[^A-Za-z0-9]").cast("int"),
    "run": lambda c: (F.length(c.t) / F.size(F.split(c.t, "(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])", -1))).cast("int"),
    "camel": lambda c: c.t.rlike("[A-Z][a-z]{3,}[A-Z][a-z]{3,}").cast("int"),
    "known": lambda c: c.t.rlike("^(?:AKIA|ASIA|ghp_|gho_|ghs_|github_pat_|glpat-|sk-|sk_live_|pk_live_|rk_live_|xox[abp]-|AIza|eyJ)").cast("int"),
    "call": lambda c: c.t.rlike("[(){}\\[\\]$*]|^(?:your|my|the|some|null|none|None|true|false|string|required|changeme)").cast("int"),
    "says_secret": lambda c: c.before.rlike(r"(?i)(?:^|[^\p{L}])(?:" + _SECRET_WORDS + r")(?:_[a-z]{1,8}){0,2}[\"']?\x20?(?:[:=]|=>|is)?\x20?[\"']?$").cast("int"),
    "says_digest": lambda c: c.before.rlike(r"(?i)(?:^|[^\p{L}])(?:commit|revision|sha-?[0-9]{0,3}|md5|checksum|digest|hash|etag|blob|tree|uuid|guid|integrity|file|path|href|src|url|id)[\"']?[\x20:=/-]{0,3}[\"']?$").cast("int"),
    "glued": lambda c: (c.before.rlike(r"[\p{L}0-9_=\"'#]$") | c.after.rlike(r"^[\p{L}0-9_=\"'%#]")).cast("int"),
}
ROUNDS, RATE, TARGET_PRECISION = 40, 0.4, 0.99


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once (higher-order functions evaluate outer references per element)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def luhn(digits: Column) -> Column:
    def step(acc: Column, i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        return acc + F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


_SPAN = "array<struct<s:int,e:int,t:string,before:string,after:string>>"


def matches(text: Column, pattern: str, when: Column) -> Column:
    """Spans of ``pattern`` from left to right with text and context; places are summed up in blocks of 200."""

    def item(h: Column, i: Column, pieces: Column) -> Column:
        left, right = F.get(pieces, i), F.get(pieces, i + 1)
        return F.struct(F.length(left).alias("gap"), h.alias("t"), F.right(left, F.lit(24)).alias("before"), F.left(right, F.lit(8)).alias("after"))

    def block_spans(items: Column) -> Column:
        start = F.struct(F.lit(0).alias("pos"), F.array().cast(_SPAN).alias("spans"))

        def add(acc: Column, x: Column) -> Column:
            s = acc["pos"] + x["gap"]
            e = s + F.length(x["t"])
            return F.struct(e.alias("pos"), F.concat(acc["spans"], F.array(F.struct(s.alias("s"), e.alias("e"), x["t"].alias("t"), x["before"].alias("before"), x["after"].alias("after")))).alias("spans"))

        return F.aggregate(items, start, add)

    def place(blocks: Column) -> Column:
        start = F.struct(F.lit(0).alias("pos"), F.array().cast("array<int>").alias("from"))
        ends = F.aggregate(blocks, start, lambda acc, b: F.struct((acc["pos"] + b["pos"]).alias("pos"), F.concat(acc["from"], F.array(acc["pos"])).alias("from")))

        def moved(b: Column, base: Column) -> Column:
            return F.transform(b["spans"], lambda x: F.struct((x["s"] + base).alias("s"), (x["e"] + base).alias("e"), x["t"].alias("t"), x["before"].alias("before"), x["after"].alias("after")))

        return _let(ends, lambda o: F.flatten(F.zip_with(blocks, o["from"], moved)))

    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.struct(hits.alias("hits"), F.split(text, pattern, -1).alias("pieces"))
    items = _let(both, lambda x: F.transform(x["hits"], lambda h, i: item(h, i, x["pieces"])))
    n_blocks = lambda x: F.sequence(F.lit(0), ((F.size(x) - 1) / 200).cast("int"))
    blocks = _let(items, lambda x: F.when(F.size(x) > 0, F.transform(n_blocks(x), lambda k: block_spans(F.slice(x, k * 200 + 1, F.lit(200))))))
    none = F.array().cast(_SPAN)
    return F.when(when, F.coalesce(_let(blocks, place), none)).otherwise(none)


def base_spans(text: Column) -> dict[str, Column]:
    """Valid base spans of each kind; failing matches are dropped, not tried again."""
    digit = text.rlike("[0-9]")
    digits = lambda x: F.regexp_replace(x["t"], "[^0-9]", "")
    size = lambda x: F.length(digits(x))
    return {
        "email": matches(text, BASE["email"], text.contains("@")),
        "ip": F.filter(matches(text, BASE["ip"], digit), lambda x: x["t"].rlike(IP_PARTS)),
        "card": F.filter(matches(text, BASE["card"], digit), lambda x: F.when(size(x).between(13, 19), _let(digits(x), luhn)).otherwise(False)),
        "phone": F.filter(matches(text, BASE["phone"], text.contains("+")), lambda x: size(x).between(9, 15)),
    }


def candidates(text: Column) -> dict[str, Column]:
    digit = text.rlike("[0-9]")
    mail = text.contains("@") | text.contains("(at)") | text.contains("[at]") | text.contains("{at}") | text.contains(" dot ")
    when = {"mail": mail, "secret": text.rlike("[A-Za-z0-9+/_-]{16}"), "password": text.rlike("(?i)pass|pwd")}
    return {g: matches(text, p, when.get(g, digit)) for g, p in GENERATORS.items()}


class _Candidate:
    def __init__(self, x: Column):
        self.t, self.before, self.after = x["t"], x["before"], x["after"]


def _features_of(generator: str, x: Column) -> Column:
    c = _Candidate(x)
    own = [F.lit(list(GENERATORS).index(generator)).alias("generator")]
    return F.struct(*own, *[f(c).cast("int").alias(n) for n, f in FEATURES.items()])


# --- boosted trees, on the driver over a bounded table of distinct feature rows


def _drawn(k: int, alphabet: str, n: int) -> str:
    """``n`` characters by rule, different for every ``k``."""
    raw = b"".join(hashlib.sha256(f"{k} {j}".encode()).digest() for j in range(n // 32 + 1))
    return "".join(alphabet[x % len(alphabet)] for x in raw[:n])


_HEX, _UPPER = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
_MIXED = _UPPER + "abcdefghijklmnopqrstuvwxyz"


def _filled(template: str, k: int) -> str:
    """{a} four digits, {b} and {c} one; {hN}, {uN}, {mN}: N characters of hex, capitals and digits, all three."""
    t = template.replace("{a}", f"{(k * 7919) % 9000 + 1000}").replace("{b}", f"{k % 9 + 1}").replace("{c}", f"{k % 5 + 1}")
    return re.sub(r"\{([hum])(\d+)\}", lambda m: _drawn(k * 31 + m.start(), {"h": _HEX, "u": _UPPER, "m": _MIXED}[m[1]], int(m[2])), t)


# contexts and formats; every third of each is held out: calibration sees only held-out formats in held-out contexts,
# training only the others
PLAIN = ["the ", "and ", "about ", "order ", "version ", "isbn ", "page ", "total ", "id ", "ref: ", "serial ", "in ", "invoice ", "item ", "with ", "release ", "price ", "section "]
CALLS = ["call ", "phone: ", "mobile ", "tel. ", "call me at ", "dial ", "fax: ", "Telefon ", "ring me on ", "cell ", "Tel: ", "phone number "]
WRITES = ["mail ", "contact: ", "the ", "write to ", "reach me: ", "and ", "ask ", "questions go to ", "e-mail "]
HOSTS = ["ip ", "host ", "server: ", "ping ", "address ", "ip address: "]
BUILDS = ["version ", "release ", "build ", "section ", "ver. ", "chapter "]
CARDS = ["card ", "visa: ", "the ", "credit card no. ", "mastercard ", "and "]
SECRETS = ['token = "', "token: ", 'secret = "', "api_key='", "API_KEY=", "access_key: ", 'client_secret: "', 'password = "', "auth_token = ", "Authorization: Bearer ", 'apikey="', '"private_key": "', "credentials: ", "session=", "the secret is "]
DIGESTS = ["commit ", "sha256: ", "md5 ", "checksum: ", "revision ", "digest = ", 'etag: "', "blob ", "uuid ", "see ", "the ", "file ", 'href="/', "id=", "in ", "hash: ", "sha1 ", "with "]
PASSWORDS = ["password: ", 'password = "', "passwd=", "pwd: ", "Password: ", "passphrase: "]
FAMILIES = [  # formats, contexts, label
    (["555-123-{a}", "(555) 123-{a}", "555.123.{a}", "1-800-555-{a}", "0{b} 30 12345{b}", "0044 20 7946 {a}", "(0{b}0) 77{a}", "0{b}1/34 5{a}", "({b}12) 555 {a}"], CALLS, 1),
    (["555-123-{a}", "(555) 123-{a}", "555.123.{a}", "1-800-555-{a}", "0{b} 30 12345{b}", "0044 20 7946 {a}", "(0{b}0) 77{a}", "0{b}1/34 5{a}", "({b}12) 555 {a}"], PLAIN, 0),
    (["+1 555 123 {a}", "+49 30 1234{a}", "+34 91 {a} 12{b}", "+33 1 {a} {a}", "+44 20 7946 {a}", "+1 ({b}55) 123-{a}"], PLAIN + CALLS, 1),
    (["2023-0{c}-1{b}", "12/0{c}/202{b}", "1{b}.0{c}.2021", "2019/1{c}/0{b}", "0{c}.1{b}.1999", "20{b}1-0{c}-0{b}"], PLAIN + CALLS[:3], 0),
    (["12345{a}", "978-3-16-14841{b}-0", "{a} {a} {a} {a}", "4{a}-1{a}-2{a}-3{a}", "100{a}{a}", "1{a}.{a}", "{a}{a}{a}{a}", "000{a}", "1 {a} {a}"], [*PLAIN, 'x = "', "n="], 0),
    (["jane.doe (at) mail{b}.example.org", "info[at]corp{b}.example.com", "bob {at} host{b}.example.net", "sam(at)example(dot)org", "kim [at] example [dot] com", "a.b@c{b}.example.com", "lee at example dot org", "pat.o at mail{b} dot example dot com", "max dot m at corp{b} dot de"], WRITES, 1),
    (["look (at) this. ok", "meet {at} noon. bye", "x@y", "looked at a dot matrix", "stare at one dot there", "aim at every dot in"], ["the ", "and ", "we ", "they ", "I ", "you "], 0),
    (["10.0.{b}.{c}", "192.168.{b}.1", "172.16.{c}.25{c}"], HOSTS, 1),
    (["10.0.{b}.{c}", "192.168.{b}.1", "172.16.{c}.25{c}"], BUILDS, 0),
    (["4111 1111 1111 1111", "5500-0000-0000-0004", "4012888888881881"], CARDS, 1),
    (["{h40}", "{m24}", "{h32}", "{m40}", "{h64}", "{m32}==", "{u20}", "{m20}-{m20}", "{m64}", "{h24}", "{m43}=", "{m16}_{m24}"], SECRETS, 1),
    (["AKIA{u16}", "ghp_{m36}", "sk-{m32}", "xoxb-{a}{a}-{m24}", "glpat-{m20}", "eyJ{m40}"], SECRETS + DIGESTS, 1),
    (["{h40}", "{h64}", "{h32}", "{h8}-{h4}-{h4}-{h4}-{h12}", "{m43}=", "{m24}", "{h24}", "{m22}==", "{h56}"], DIGESTS, 0),
    (["internationalization", "my_long_function_name_{b}", "Donaudampfschifffahrtsgesellschaft", "some-page-title-in-lower-case", "path/to/some/module/file", "AAAAAAAAAAAAAAAAAAAAAAAA", "------------------------", "2023-01-1{b}-some-post-title", "CamelCaseFactoryBean{b}Impl", "{a}{a}{a}{a}{a}", "get_next_token_from_stream", "step-{b}-of-the-long-recipe", "AbstractUserTokenProvider{b}", "JdbcConnectionPoolFactory{b}"], SECRETS + DIGESTS, 0),
    (["hunter{b}!", "S3cr3tP4ss{b}", "Tr0ub4dor&{b}", "x7Kp{b}2qLm", "correct-horse-{b}", "{m12}", "qwerty{a}", "W!nter{a}", "blue{b}Moon{c}"], PASSWORDS, 1),
    (["required", "******", "getPassword()", "your_password", "string", "${PASSWORD}", "changeme", "request.form[x]", "hidden"], PASSWORDS, 0),
]


def examples() -> list[tuple[str, int, bool]]:
    """Labelled sentences with one candidate each; whether its format and context are held out."""
    out, k = [], 0
    for formats, contexts, label in FAMILIES:
        for i, t in enumerate(formats):
            for j, c in enumerate(contexts):
                if (i % 3 == 2) == (j % 3 == 2):
                    k += 1
                    end = c[-1] if c[-1] in "\"'" else ""
                    out.append((c + _filled(t, k) + end + " there", label, i % 3 == 2))
    return out


def boost(rows: list[tuple[tuple[int, ...], int, int]], rounds: int = ROUNDS, rate: float = RATE) -> list[tuple]:
    """Depth-two trees on the logistic loss over (features, label, count); nodes (feature, threshold, low, high), leaves floats."""
    x, y, n = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float), np.array([r[2] for r in rows], float)
    score = np.zeros(len(rows))
    trees = []

    def best(idx: np.ndarray, grad: np.ndarray, hess: np.ndarray, depth: int):
        g, h = grad[idx].sum(), hess[idx].sum()
        choice, gain = None, 1e-6
        for f in range(x.shape[1] if depth else 0):
            values, at = np.unique(x[idx, f], return_inverse=True)
            gl, hl = np.cumsum(np.bincount(at, grad[idx]))[:-1], np.cumsum(np.bincount(at, hess[idx]))[:-1]
            got = gl * gl / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g * g / (h + 1)
            if len(got) and got.max() > gain:
                choice, gain = (f, int(values[got.argmax()])), got.max()
        if choice is None:
            return float(rate * g / (h + 1))
        low = x[idx, choice[0]] <= choice[1]
        return (*choice, best(idx[low], grad, hess, depth - 1), best(idx[~low], grad, hess, depth - 1))

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        tree = best(np.arange(len(rows)), n * (y - p), n * p * (1 - p), 2)
        trees.append(tree)
        score += np.array([value(tree, r[0]) for r in rows])
    return trees


def value(tree, x: tuple[int, ...]) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return tree


def _expression(tree, x: Column, names: list[str]) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    return F.when(x[names[tree[0]]] <= tree[1], _expression(tree[2], x, names)).otherwise(_expression(tree[3], x, names))


def thresholds(trees: list[tuple], held: list[tuple[tuple[int, ...], int, int]], target: float = TARGET_PRECISION) -> dict[str, float]:
    """Per generator the lowest score from which on the held-out examples reach the target precision, halfway to the next one below."""
    out = {}
    for g, name in enumerate(GENERATORS):
        own = sorted(((sum(value(t, x) for t in trees), y, n) for x, y, n in held if x[0] == g), reverse=True)
        best, hit, all_ = math.inf, 0, 0
        for k, (s, y, n) in enumerate(own):
            hit, all_ = hit + n * y, all_ + n
            if hit >= target * all_ and (k + 1 == len(own) or own[k + 1][0] < s):
                best = (s + (own[k + 1][0] if k + 1 < len(own) else s - 2)) / 2
        out[name] = max(best, 0.0)
    return out


def labelled(spark: SparkSession) -> dict[bool, list[tuple[tuple[int, ...], int, int]]]:
    """(features, label, count) of the distinct feature rows of the library's examples, by whether they are held out."""
    rows = F.from_json(F.lit(json.dumps([{"text": t, "y": y, "held": h} for t, y, h in examples()])), "array<struct<text:string,y:int,held:boolean>>")
    one = spark.range(1).select(F.inline(rows))
    each = F.flatten(F.array(*[F.transform(c, partial(_features_of, g)) for g, c in candidates(F.col("text")).items()]))
    names = ["generator", *FEATURES]
    counted = one.select("held", "y", F.inline(each)).groupBy("held", "y", *names).agg(F.count("*").alias("n")).orderBy("held", "y", *names).collect()
    return {h: [(tuple(r[n] for n in names), r["y"], r["n"]) for r in counted if r["held"] == h] for h in (True, False)}


def fit(spark: SparkSession) -> tuple[list[tuple], dict[str, float]]:
    """Trees from the training examples, thresholds from the held-out ones."""
    split = labelled(spark)
    trees = boost(split[False])
    return trees, thresholds(trees, split[True])


# --- spans of texts


def pii_spans(text: Column, model: tuple[list[tuple], dict[str, float]]) -> Column:
    """Struct ``base`` and ``added``: arrays of (k, s, e), k the kind's place in ``KINDS``, in order."""
    trees, least = model
    names = ["generator", *FEATURES]
    size = lambda x: F.length(F.regexp_replace(x["t"], "[^0-9]", ""))
    kind = {"mail": lambda x: F.lit(0), "quad": lambda x: F.lit(1), "number": lambda x: F.when(size(x) > 15, 2).otherwise(3), "secret": lambda x: F.lit(4), "password": lambda x: F.lit(4)}

    def with_kind(spans: Column, k: int) -> Column:
        return F.transform(spans, lambda x: F.struct(F.lit(k).alias("k"), x["s"].alias("s"), x["e"].alias("e")))

    def score(f: Column) -> Column:
        total = F.lit(0.0)
        for t in trees:
            total = total + _expression(t, f, names)
        return total

    def scored(g: str, x: Column) -> Column:
        return _let(_features_of(g, x), score) >= least[g]

    def placed(g: str, x: Column) -> Column:
        return F.struct(kind[g](x).cast("int").alias("k"), x["s"].alias("s"), x["e"].alias("e"))

    base = F.concat(*[with_kind(s, k) for k, s in enumerate(base_spans(text).values())])
    chosen = []
    for g, spans in candidates(text).items():
        if math.isfinite(least[g]):
            good = F.filter(spans, partial(scored, g))
            chosen.append(F.transform(good, partial(placed, g)))
    none = F.array().cast("array<struct<k:int,s:int,e:int>>")
    proposed = F.concat(none, *chosen)
    both = F.struct(F.array_sort(base).alias("base"), proposed.alias("proposed"))
    clear = lambda x, b: ~F.exists(b, lambda y: (y["s"] < x["e"]) & (x["s"] < y["e"]))
    return _let(both, lambda v: F.struct(v["base"].alias("base"), F.array_sort(F.array_distinct(F.filter(v["proposed"], lambda x: clear(x, v["base"])))).alias("added")))


def _joined(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in ALL_KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def _is_kind(k: int, x: Column) -> Column:
    return x["k"] == k


def find_pii(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: counts of the base spans, their digest, all spans, how many the classifier added, how many of these are
    secrets (``n_secret``), and how many spans there are in all (``n_spans``)."""
    model = fit(df.sparkSession)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    found = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.inline(F.array(pii_spans(text, model))))
    counts = [F.size(F.filter("base", partial(_is_kind, k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    secrets = F.size(F.filter("added", partial(_is_kind, len(KINDS)))).cast("long").alias("n_secret")
    spans = F.array_sort(F.concat("base", "added"))
    return found.select("doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(spans).alias("spans"), F.size("added").cast("long").alias("n_added"), secrets, F.size(spans).cast("long").alias("n_spans"))


def redact(df: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``df`` with every span in its text replaced by its kind in brackets (overlapping spans: by the first one's)."""
    model = fit(df.sparkSession)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    kinds = F.array(*[F.lit(f"[{k.upper()}]") for k in ALL_KINDS])
    found = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.inline(F.array(pii_spans(text, model))))
    by_start = F.array_sort(F.transform(F.concat("base", "added"), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k"))))
    row_text = F.col("_row").getField(text_col)
    start = F.struct(F.lit(0).alias("pos"), F.lit("").alias("out"))

    def add(acc: Column, x: Column) -> Column:
        put = F.concat(acc["out"], F.substring(row_text, acc["pos"] + 1, x["s"] - acc["pos"]), F.get(kinds, x["k"]))
        return F.struct(F.greatest(acc["pos"], x["e"]).alias("pos"), F.when(x["s"] >= acc["pos"], put).otherwise(acc["out"]).alias("out"))

    whole = _let(F.aggregate(by_start, start, add), lambda a: F.concat(a["out"], F.substring(row_text, a["pos"] + 1, F.length(row_text))))
    new = F.when(F.size(F.concat("base", "added")) == 0, row_text).otherwise(whole)
    return found.select(*[(new if c == text_col else F.col("_row").getField(c)).alias(c) for c in df.columns])
