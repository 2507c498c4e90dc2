"""Problem 10: template residue, filler, error pages and script notices in place of content.

Character n-gram models (orders 3 and 5, hashed) are fitted for filler and notices from seed texts, and for natural prose
from the long lines of the whole corpus; a model over the shapes of characters (letters by case, digits, brackets) is fitted
for placeholders. What the seeds' models find in the corpus, whole lines of it, joins them, and leaves the natural one, before the
last pass (self-training). Windows of the likelihood ratio localise residue. A line, or a sentence of one, counts as filler or
notice by the share of it that such windows cover; a placeholder is a bracketed run that a window of the shape model covers, unless
the text around it names or explains it.

Defined results: null, empty and blank texts are no cases; repeated texts are cases each; all rows are scored, whole.
"""

from __future__ import annotations

import functools
import itertools
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORDERS, BITS = (3, 5), 19
BUCKETS = 1 << BITS
#: Windows in characters, the mean log ratio that marks one, and the share of a line that must be covered, and of a sentence
#: inside a longer line.
WINDOW, MARK, COVERAGE, SENTENCE_COVERAGE = 12, 0.7, 0.6, 0.85
#: The share at which a line joins the models.
LEARNT_COVERAGE = 0.4
#: A covered stretch of this many characters counts whatever the line's length.
LONG_RUN = 90
#: Lines of at least so many symbols are taken for prose.
PROSE_LEAST = 60
PLACE_WINDOW, PLACE_MARK = 4, 1.0
#: Log ratio, at most, of an n-gram that the seeds lack: what neither model knows is no evidence of residue.
UNSEEN = -1.0
#: How much the lines found in the corpus weigh against the seeds, at most.
FOUND_WEIGHT = 4.0
BLOCK_CHARS = 400_000

# Seed texts of the residue models: usual wordings of such notices and of filler; digits are alike.
FILLER_SEEDS = [
    "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore magna aliqua.",
    "Ut enim ad minim veniam, quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat.",
    "Duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur.",
    "Excepteur sint occaecat cupidatat non proident, sunt in culpa qui officia deserunt mollit anim id est laborum.",
    "Sed ut perspiciatis unde omnis iste natus error sit voluptatem accusantium doloremque laudantium, totam rem aperiam.",
    "Đây là văn bản mẫu, hãy thay bằng nội dung thật.", "Văn bản giữ chỗ", "Đoạn văn mẫu dùng để trình bày bố cục trang.", "Nội dung mẫu. Nội dung mẫu.", "Nội dung thử nghiệm, xóa trước khi xuất bản.", "Đoạn văn thử, xóa trước khi đăng bài.", "Đoạn văn bản thử nghiệm số 1.", "Nhập tiêu đề tại đây", "Tiêu đề bài viết ở đây", "Nhập nội dung tại đây", "Mô tả ngắn ở đây",
    "Nội dung đang cập nhật", "Đang cập nhật nội dung, vui lòng quay lại sau.", "Nội dung sẽ được cập nhật sau.", "Bài viết đang được biên soạn, mời bạn quay lại sau.", "Chưa có nội dung", "Chèn văn bản vào đây", "Thay đoạn này bằng nội dung của bạn.",
    "This is placeholder text.", "Placeholder text, please replace.", "Replace this text with your own content.", "Your content goes here.", "Your title goes here", "Insert your text here", "Add your description here", "Sample text", "Dummy text", "Content coming soon", "Coming soon", "More content will be added soon.", "This page is under construction.", "To be determined", "To be announced", "TBD", "TBA", "TODO", "Click here to edit this text", "Text goes here. Text goes here.",
    "Texte de remplissage, à remplacer.", "Contenu à venir", "Hier steht ein Beispieltext.", "Inhalt folgt", "Texto de ejemplo", "Здесь будет текст", "Текст-заполнитель", "此处填写内容", "内容待更新", "ここにテキストが入ります。", "내용을 입력하세요", "ใส่ข้อความที่นี่",
]
#: Keys struck at random and words said again, from which filler lines are made by repeating two of them.
FILLER_WORDS = ["asdf", "qwer", "qwerty", "zxcv", "asdfgh", "hjkl", "jkl", "aaa", "bbb", "ccc", "xxx", "xxxx", "abc", "test", "test 123", "foo", "bar", "blah", "bla", "text", "lorem"]
NOTICE_SEEDS = [
    "404 Not Found", "Page not found", "Error 404: page not found.", "The requested URL was not found on this server.", "We could not find the page you are looking for. It may have been moved or deleted.", "Go back to the home page.", "HTTP Error 500", "Status code: 500", "Error code: 503", "500 Internal Server Error", "502 Bad Gateway", "503 Service Unavailable", "504 Gateway Timeout", "400 Bad Request", "403 Forbidden", "401 Unauthorized",
    "Something went wrong. Please try again later.", "An unexpected error has occurred while processing your request.", "The server did not respond in time.", "The server is not responding", "Access denied. You do not have permission to view this page.", "You are not authorized to access this resource.", "Your session has expired. Please sign in again.", "The site is temporarily down for maintenance. We apologise for the inconvenience.", "Connection timed out", "Could not connect to the database server.", "Error establishing a database connection", "Reload the page", "Try again", "Request ID: 0a1b2c", "Invalid response received from the upstream server",
    "Traceback (most recent call last):\n  File \"/app/main.py\", line 10, in <module>\nKeyError: 'name'\nValueError: invalid value\nTypeError: unsupported operand", "Exception in thread \"main\" java.lang.NullPointerException\n\tat com.example.Main.run(Main.java:12)\n\tat org.example.App.start(App.java:34)", "java.lang.IllegalStateException\n\tat app.Page.open(Page.java:7)\nCaused by: java.io.IOException", "Warning: include(header.php): failed to open stream: No such file or directory in /var/www/html/index.php on line 3", "Fatal error: Uncaught Error: Call to undefined function in /var/www/html/index.php on line 3", "Parse error: syntax error, unexpected end of file in index.php on line 8", "Notice: Undefined index in view.php on line 5", "Unhandled exception at line 1", "Segmentation fault (core dumped)",
    "Không tìm thấy trang bạn yêu cầu.", "Lỗi 404: trang không tồn tại", "Trang bạn tìm không tồn tại hoặc đã bị xóa.", "Đường dẫn có thể đã bị thay đổi hoặc gỡ bỏ.", "Trở về trang chủ", "Quay lại trang chủ", "Lỗi máy chủ nội bộ", "Máy chủ gặp lỗi, vui lòng thử lại sau.", "Đã có lỗi xảy ra. Vui lòng thử lại sau ít phút.", "Bạn không có quyền truy cập trang này.", "Truy cập bị từ chối", "Từ chối truy cập", "Phiên đăng nhập đã hết hạn. Vui lòng đăng nhập lại.", "Phiên làm việc của bạn đã kết thúc do hết hạn, mời bạn đăng nhập lại để tiếp tục.", "Hệ thống đang bảo trì. Mong bạn thông cảm và quay lại sau.", "Trang web đang được nâng cấp, xin quý khách thông cảm.", "Trang tạm dừng để bảo trì từ 22 giờ đến 2 giờ, mong quý khách thông cảm.", "Rất tiếc, hệ thống đang gặp sự cố.", "Rất tiếc, đã xảy ra sự cố. Mã lỗi: 500", "Mã sự cố: 123", "Mã yêu cầu: 0a1b2c", "Hệ thống quá tải, đang bận, mời thử lại.", "Không kết nối được cơ sở dữ liệu.", "Không thể kết nối máy chủ", "Hết thời gian chờ (timeout) sau 60 giây.", "Kết nối tới máy chủ bị gián đoạn.", "Tải lại trang",
    "Page introuvable", "Erreur 404 : la page demandée n'existe pas.", "Erreur interne du serveur", "Retour à l'accueil", "Accès refusé", "Service momentanément indisponible, veuillez réessayer plus tard.", "Seite nicht gefunden", "Interner Serverfehler", "Zurück zur Startseite", "Página no encontrada", "Error del servidor", "Страница не найдена", "Ошибка 404", "Ошибка сервера", "Доступ запрещён", "Вернуться на главную страницу", "Попробуйте позже",
    "页面不存在", "找不到您访问的页面", "返回首页", "服务器错误，请稍后再试。", "访问被拒绝", "系统维护中", "ページが見つかりません", "お探しのページは存在しません。", "トップページへ戻る", "サーバーエラーが発生しました。", "페이지를 찾을 수 없습니다", "요청하신 페이지가 존재하지 않습니다.", "서버 오류가 발생했습니다.", "홈으로 돌아가기", "ไม่พบหน้าที่คุณค้นหา", "เกิดข้อผิดพลาดของเซิร์ฟเวอร์", "กลับไปหน้าแรก", "पृष्ठ नहीं मिला", "सर्वर त्रुटि",
    "Please enable JavaScript in your browser.", "JavaScript is required to use this site.", "You need to enable JavaScript to run this app.", "This page requires JavaScript.", "JavaScript is disabled. Please turn it on and reload the page.", "Your browser does not support scripts.", "Please allow scripts and cookies to continue.", "Enable cookies and scripts to view this content.", "Checking your browser before accessing the site.", "Please wait while we verify your browser.", "noscript", "Loading…", "If the page stays blank, check your JavaScript settings.",
    "Trình duyệt của bạn chưa bật JavaScript.", "Vui lòng bật JavaScript để sử dụng trang này.", "Hãy bật JavaScript rồi tải lại trang để xem nội dung.", "Trang này cần JavaScript để hiển thị.", "Trình duyệt không hỗ trợ mã kịch bản (script).", "Cần cho phép cookie và tập lệnh để tải nội dung.", "Nội dung chỉ hiển thị khi trình duyệt bật tập lệnh.", "Đang tải, vui lòng kiểm tra cài đặt JavaScript của trình duyệt.",
    "Veuillez activer JavaScript dans votre navigateur.", "Ce site nécessite JavaScript.", "Bitte aktivieren Sie JavaScript.", "Active JavaScript en su navegador.", "Включите JavaScript в браузере.", "Для просмотра страницы необходим JavaScript.", "请启用JavaScript以浏览本页面。", "您的浏览器未启用脚本。", "请开启脚本后刷新页面。", "JavaScriptを有効にしてください。", "このサイトの表示にはJavaScriptの有効化が必要です。", "スクリプトを有効にしてください。", "자바스크립트를 활성화해 주세요.", "이 페이지를 보려면 스크립트를 켜야 합니다.", "โปรดเปิดใช้งาน JavaScript", "कृपया जावास्क्रिप्ट चालू करें।",
]
#: Names of fields, and the forms in which templates mark them; a name of one plain word is a mark in the forms of PLAIN_FORMS only.
IDENTIFIERS = ["customer_name", "order_id", "phone_number", "userName", "orderDate", "ma_don_hang", "tenKhachHang", "FIRST_NAME", "ORDER_TOTAL", "EMAILADDRESS", "postalcode.main", "billing_postal_code", "BILLING_POSTAL_CODE", "OrderDate"]
PLAIN_IDENTIFIERS = ["email", "Quantity", "PRICE"]
PLACE_FORMS = ["{{%s}}", "{{ %s }}", "${%s}", "#{%s}", "[[%s]]", "<%%= %s %%>", "{%%%s%%}", "{%% %s %%}", "%%%s%%", "%%(%s)s", "$%s$", "@@%s@@", "__%s__", "«%s»", "<%s>", "{%s}"]
PLAIN_FORMS = ["{{%s}}", "{{ %s }}", "${%s}", "#{%s}", "[[%s]]", "<%%= %s %%>", "{%%%s%%}", "{%% %s %%}", "%%(%s)s", "@@%s@@", "__%s__", "%%%s%%", "{%s}"]
ASKING_FORMS = ["[insert %s here]", "[enter %s]", "[your %s]", "[điền %s]", "[nhập %s]", "[chèn %s]", "[ghi %s]", "[insérer %s]", "[вставить %s]"]
ASKED = ["your name", "tên cơ quan", "ngày tháng", "title", "customer_name", "orderDate", "FIRST_NAME"]

#: Where a placeholder may begin and end; what lies between is judged by the model. Each form starts with a mark itself, and looks
#: back past it, as only then are the marks alone looked for in a text.
_BRACKETED = re.compile(r"\{\{[^{}\n]{1,60}\}\}|\$\{[^{}\n]{1,60}\}|#\{[^{}\n]{1,60}\}|\{%[^{}\n]{1,60}%\}|\{[^{}\n]{1,60}\}|\[\[[^\[\]\n]{1,60}\]\]|\[[^\[\]\n]{1,60}\]|<%[^<>\n]{1,60}%>|<[^<>\n]{1,60}>|«[^«»\n]{1,60}»|%\([^()\n]{1,60}\)s|%(?<![\w%]%)[^\W\d][\w.]{1,60}%(?!\w)|\$(?<![\w$]\$)[^\W\d][\w.]{1,60}\$(?!\w)|@@[^@\s]{1,60}@@|__(?<!\w__)(?!_)\w{1,60}?__(?!\w)")
_OPENING = "{[<«%$@_"
#: Words before a placeholder, or marks around it, that make it a thing spoken about.
_NAMED = re.compile(r"(?:có dạng|dạng|cú pháp|ký hiệu|ví dụ|chẳng hạn|gọi là|mang tên|of the form|such as|like|e\.g\.|for example|par exemple|например|例如|[“\"‘'`「（(])\s*[:“\"‘'`「]?\s*$", re.I)
_ASKED = re.compile(r"\[(?:insert|enter|your|điền|nhập|chèn|ghi rõ|insérer|вставить|请填写|入力)\s[^\]\n]{1,60}\]", re.I)
_SENTENCE_END = re.compile(r"(?<=[.!?。！？])\s+|(?<=[。！？])")


@functools.cache
def _normal_table() -> np.ndarray:
    """Code point -> its n-gram symbol: lower case, digits alike, line ends alike, other white space a blank."""
    table = np.arange(0x110000, dtype=np.uint32)
    for cp in range(0x10000):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        c = chr(cp)
        if unicodedata.category(c) == "Nd":
            table[cp] = 0x30
        elif c in "\n\r\v\f\x85  ":
            table[cp] = 10
        elif c.isspace():
            table[cp] = 0x20
        else:
            low = c.lower()
            table[cp] = ord(low) if len(low) == 1 else cp
    return table


_FACTORS = np.array([2654435761, 2246822519, 3266489917, 668265263, 374761393], np.uint32)


@functools.cache
def _is_letter() -> np.ndarray:
    return _shape_table() == 0x61


@functools.cache
def _shape_table() -> np.ndarray:
    """Code point -> its shape: a for small letters and those without case, A for capitals, 0 for digits, else itself."""
    table = np.arange(0x110000, dtype=np.uint32)
    for cp in range(0x32400):
        if not 0xD800 <= cp <= 0xDFFF:
            cat = unicodedata.category(chr(cp))
            if cat in ("Lu", "Lt"):
                table[cp] = 0x41
            elif cat[0] in "LM":
                table[cp] = 0x61
            elif cat[0] == "N":
                table[cp] = 0x30
            elif chr(cp) in "\n\r\v\f\x85\u2028\u2029":
                table[cp] = 10
            elif chr(cp).isspace():
                table[cp] = 0x20
    return table


def symbols(texts: list[str], shapes: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, their code point positions, start of each text among the symbols), each text between line ends.

    Runs of digits, of blanks and of line ends are one symbol; of shapes, runs of letters of one case too.
    """
    raw = (_shape_table() if shapes else _normal_table())[np.frombuffer(("\n" + "\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)]
    keep = np.ones(len(raw), bool)
    keep[1:] = (raw[1:] != raw[:-1]) | ((raw[1:] != 0x41) & (raw[1:] != 0x61) & (raw[1:] > 0x20) & (raw[1:] != 0x30) if shapes else (raw[1:] > 0x39) | (raw[1:] == 0x2E))
    at = np.cumsum([1] + [len(t) + 1 for t in texts])
    keep[at[:-1]] = True
    where = np.flatnonzero(keep)
    return raw[where], where, np.searchsorted(where, at)


def grams(sym: np.ndarray, order: int = ORDERS[-1]) -> np.ndarray:
    """Bucket of the n-gram that ends at each symbol. What lies before the symbol's line counts as line ends."""
    at = np.arange(len(sym), dtype=np.int32)
    ends = np.where(sym == 10, at, -1)
    depth = at.copy()
    depth[1:] -= np.maximum.accumulate(ends)[:-1]
    h = sym * _FACTORS[0]
    for k in range(1, order):
        h[k:] += np.where(depth[k:] >= k, sym[:-k], np.uint32(10)) * _FACTORS[k]
        h[:k] += np.uint32(10 * int(_FACTORS[k]) & 0xFFFFFFFF)
    h ^= h >> np.uint32(15)
    h *= np.uint32(2246822519)
    return h >> np.uint32(32 - BITS)


def prose(sym: np.ndarray) -> np.ndarray:
    """Whether each symbol is in a line of PROSE_LEAST symbols or more."""
    ends = np.flatnonzero(sym == 10)
    size = np.diff(ends, prepend=-1)
    return np.repeat(size >= PROSE_LEAST, size) if len(ends) and ends[-1] == len(sym) - 1 else np.zeros(len(sym), bool)


# Tables of counts: natural prose by order, and by shape.
NATURAL, FOUND_FILLER, FOUND_NOTICE = range(3)


def _tables(sym: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    return np.stack([np.bincount(grams(sym, n)[chosen], minlength=BUCKETS) for n in ORDERS])


def _sums(df: DataFrame, run, tables: int) -> np.ndarray:
    """(tables, BUCKETS) sums of what run yields for each block of texts. At most BUCKETS rows come to the driver."""

    def task(batches):
        total = np.zeros((tables, BUCKETS), np.int64)
        for b in batches:
            for texts in _blocks(b.column(0).to_pylist()):
                total += run(texts)
        at = np.flatnonzero(total.any(axis=0))
        for a in range(0, len(at), 50_000):
            part = at[a : a + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), *(pa.array(t[part]) for t in total)], names=["bucket", *(f"n{i}" for i in range(tables))])

    names = [f"n{i}" for i in range(tables)]
    rows = df.mapInArrow(task, "bucket int, " + ", ".join(f"{n} bigint" for n in names)).groupBy("bucket").agg(*(F.sum(n).alias(n) for n in names)).toArrow()
    out = np.zeros((tables, BUCKETS), np.int64)
    for i in range(tables):
        out[i, rows.column("bucket").to_numpy()] = rows.column(f"n{i}").to_numpy()
    return out


def natural_counts(texts: list[str]) -> np.ndarray:
    """(orders + 1, BUCKETS) counts of n-grams in prose by order, and of shape n-grams outside of anything bracketed."""
    sym, shape = symbols(texts)[0], symbols([_BRACKETED.sub(" ", t) if any(c in t for c in _OPENING) else t for t in texts], shapes=True)[0]
    return np.concatenate([_tables(sym, prose(sym)), np.bincount(grams(shape), minlength=BUCKETS)[None]])


def found_counts(texts: list[str], model: np.ndarray) -> np.ndarray:
    """(3 * orders, BUCKETS) counts of n-grams in filler and in notices that the model finds, and of those among prose."""
    held: tuple[list[str], list[str]] = ([], [])
    for t, spans in zip(texts, find_residue(texts, model, LEARNT_COVERAGE, placeholders=False)):
        for s, e, kind in spans:
            held[kind == "notice"].append(t[s:e])
    out = np.zeros((3 * len(ORDERS), BUCKETS), np.int64)
    for k, lines in enumerate(held):
        if lines:
            sym = symbols(lines)[0]
            out[k * len(ORDERS) : (k + 1) * len(ORDERS)] = _tables(sym, np.ones(len(sym), bool))
            out[2 * len(ORDERS) :] += _tables(sym, prose(sym))
    return out


def _blocks(texts: list[str]):
    block, size = [], 0
    for t in texts:
        block.append(t)
        size += len(t)
        if size >= BLOCK_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def _log_model(counts: np.ndarray, alpha: float) -> np.ndarray:
    return np.log((counts + alpha) / (counts.sum() + alpha * BUCKETS)).astype(np.float32)


@functools.cache
def seed_counts() -> tuple[np.ndarray, np.ndarray]:
    """((2, orders, BUCKETS) counts of the filler and notice seeds, counts of the placeholder seeds' shapes)."""
    mash = [" ".join([a, b] * 6) if a != b else " ".join([a] * 8) for a in FILLER_WORDS for b in FILLER_WORDS] + [c * 40 for c in "xaz."[:3]]
    lines = []
    for texts in (FILLER_SEEDS, NOTICE_SEEDS):
        sym = symbols(texts)[0]
        lines.append(_tables(sym, np.ones(len(sym), bool)).astype(np.float64))
    sym = symbols(mash)[0]
    lines[0] += 0.3 * _tables(sym, np.ones(len(sym), bool))
    places = [f"a: {f % i} a" for f, i in [*itertools.product(PLACE_FORMS, IDENTIFIERS), *itertools.product(PLAIN_FORMS, PLAIN_IDENTIFIERS)]] + [form % i for form, i in itertools.product(ASKING_FORMS, IDENTIFIERS)]
    shape = symbols(places, shapes=True)[0]
    return np.stack(lines), np.bincount(grams(shape), minlength=BUCKETS).astype(np.float64)


def fit(natural: np.ndarray, found: np.ndarray | None = None) -> np.ndarray:
    """(2 * orders + 1, BUCKETS) log ratios: of filler and of notices to prose by order, and of placeholders' shapes to all."""
    seeds, places = seed_counts()
    models = []
    for k in range(2):
        for j, _ in enumerate(ORDERS):
            counts, base = seeds[k, j], natural[j].astype(np.float64)
            if found is not None:
                own = found[k * len(ORDERS) + j]
                counts = counts + own * min(1.0, FOUND_WEIGHT * counts.sum() / max(1, own.sum()))
                base = np.maximum(base - found[2 * len(ORDERS) + j], 0)
            ratio = _log_model(counts, 0.02) - _log_model(base, 0.05 * max(1.0, base.sum() / BUCKETS))
            models.append(np.where(counts > 0, ratio, np.minimum(ratio, UNSEEN)))
    ratio = _log_model(places, 0.02) - _log_model(natural[-1], 0.05 * max(1.0, natural[-1].sum() / BUCKETS))
    models.append(np.where(places > 0, np.maximum(ratio, -1.0), np.minimum(ratio, UNSEEN)))
    return np.stack(models)


def _covered(ratio: np.ndarray, width: int, mark: float) -> np.ndarray:
    """Positions inside windows of the given width whose mean ratio reaches the mark."""
    if len(ratio) < width:
        return np.full(len(ratio), bool(len(ratio)) and ratio.mean() >= mark)
    total = np.concatenate([[0.0], np.cumsum(ratio, dtype=np.float64)])
    hit = (total[width:] - total[:-width]) / width >= mark
    edge = np.zeros(len(ratio) + 1, np.int32)
    at = np.flatnonzero(hit)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + width, -1)
    return np.cumsum(edge[:-1]) > 0


def find_residue(texts: list[str], model: np.ndarray, coverage: float = COVERAGE, placeholders: bool = True) -> list[list[tuple[int, int, str]]]:
    """(start, end, kind) of the residue in each text, in code points; kind is filler, notice or, where they are asked for, placeholder."""
    sym, where, begins = symbols(texts)
    by_order = [grams(sym, n) for n in ORDERS]
    ratios = [np.mean([np.clip(model[k * len(ORDERS) + j][g], -4, 6) for j, g in enumerate(by_order)], axis=0) for k in range(2)]
    found: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    # lines of the symbol array; every text starts and ends at one
    ends = np.flatnonzero(sym == 10)
    a, b = ends[:-1] + 1, ends[1:]
    some = b > a
    a, b = a[some], b[some]
    text_of = np.searchsorted(begins, a, "right") - 1
    starts = np.cumsum([1] + [len(t) + 1 for t in texts])

    def span(x: int, y: int, i: int) -> tuple[int, int]:
        return int(where[x] - starts[i]), int(where[y - 1] + 1 - starts[i])

    both = np.maximum(ratios[0], ratios[1])
    cover = _covered(both, WINDOW, MARK)
    held = np.concatenate([[0], np.cumsum(cover)])
    summed = np.concatenate([[0.0], np.cumsum(both, dtype=np.float64)])

    def kind_of(x: int, y: int) -> str:
        return "filler" if ratios[0][x:y].sum() >= ratios[1][x:y].sum() else "notice"

    # the n-gram that closes a line ends at its line end, so the end counts to the line
    size = b - a + 1
    share = (held[b + 1] - held[a]) / size
    mean = (summed[b + 1] - summed[a]) / size
    # a line shorter than a window is one, without its first grams, which are mostly line ends
    short = (size > 3) & (size <= WINDOW)
    from_ = np.where(short, a + 2, a)
    mean = np.where(short, (summed[b + 1] - summed[from_]) / (b + 1 - from_), mean)
    share = np.where(short, mean >= MARK, share)
    share[size <= 3] = 0
    letter = np.concatenate([[0], np.cumsum(_is_letter()[sym])])
    whole = (share >= coverage) & (mean >= MARK / 2 * (coverage / COVERAGE) ** 2) & (2 * (letter[b] - letter[a]) >= b - a)
    for k in np.flatnonzero(whole):
        i, x, y = int(text_of[k]), int(a[k]), int(b[k])
        found[i].append((*span(x, y, i), kind_of(x, y + 1)))
    for k in np.flatnonzero(~whole & (held[b + 1] - held[a] >= WINDOW)):
        i, x, y = int(text_of[k]), int(a[k]), int(b[k])
        s, e = span(x, y, i)
        line, got = texts[i][s:e], []
        # sentences of the line that are covered whole, unless the line quotes or names them
        cuts = [0, *(m.end() for m in _SENTENCE_END.finditer(line)), len(line)]
        for p, q in zip(cuts, cuts[1:]):
            u, v = np.searchsorted(where, [starts[i] + s + p, starts[i] + s + q])
            if q - p >= 2 * WINDOW and v > u and (held[v] - held[u]) >= SENTENCE_COVERAGE * (v - u) and not _NAMED.search(line[:p]) and line[p] not in "“\"‘'«「":
                got.append((s + p, s + p + len(line[p:q].rstrip()), kind_of(u, v)))
        if not got and held[y + 1] - held[x] >= LONG_RUN:
            edges = np.flatnonzero(np.diff(np.concatenate([[0], cover[x : y + 1].astype(np.int8), [0]])))
            got = [(*span(x + int(u), min(x + int(v), y), i), kind_of(x + u, x + v)) for u, v in zip(edges[::2], edges[1::2]) if v - u >= LONG_RUN]
        found[i] += got
    if placeholders and any(c in t for t in texts for c in _OPENING):
        _find_placeholders(texts, model[-1], found)
    return found


def _find_placeholders(texts: list[str], ratio: np.ndarray, found: list[list[tuple[int, int, str]]]) -> None:
    """Adds the bracketed runs that a window of the shape model covers from end to end, and that nothing names."""
    shape, at, _ = symbols(texts, shapes=True)
    hit = _covered(np.clip(ratio[grams(shape)], -4, 6), PLACE_WINDOW, PLACE_MARK)
    total = np.concatenate([[0], np.cumsum(hit)])
    starts = np.cumsum([1] + [len(t) + 1 for t in texts])
    for i, t in enumerate(texts):
        for m in _BRACKETED.finditer(t):
            u, v = np.searchsorted(at, [starts[i] + m.start(), starts[i] + m.end()])
            inner = m.group().strip("{}[]<>«»%$#@_()= ")
            asked = _ASKED.match(m.group())
            if (asked or total[v] - total[u] >= 0.7 * (v - u)) and len(inner) > 1 and not _NAMED.search(t[max(0, m.start() - 30) : m.start()]):
                found[i].append((m.start(), m.end(), "placeholder"))


_SPANS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("kind", T.StringType())])


def fitted(df: DataFrame, text_col: str = "text") -> np.ndarray:
    """The models of a corpus: fitted on the seeds, then on what these find in it."""
    texts = df.select(text_col).where(F.col(text_col).isNotNull())
    natural = _sums(texts, natural_counts, len(ORDERS) + 1)
    first = df.sparkSession.sparkContext.broadcast(fit(natural))
    return fit(natural, _sums(texts, lambda block: found_counts(block, first.value), 3 * len(ORDERS)))


def residue_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", model=None) -> DataFrame:
    """(doc_id, start, end, kind) of all residue of all texts."""
    model = model or df.sparkSession.sparkContext.broadcast(fitted(df, text_col))

    def run(batches):
        for b in batches:
            ids, at = b.column(0).to_pylist(), 0
            for texts in _blocks(b.column(1).to_pylist()):
                rows = [(ids[at + i], *span) for i, spans in enumerate(find_residue(texts, model.value)) for span in spans]
                at += len(texts)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int32(), pa.string()))], names=_SPANS.names)

    return df.select(F.col(id_col).cast("bigint"), text_col).where(F.col(text_col).isNotNull() & (F.trim(F.col(text_col)) != "")).mapInArrow(run, _SPANS)


def residue_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans, characters) of the documents with residue."""
    return residue_spans(df, id_col, text_col).groupBy("doc_id").agg(F.count("*").alias("spans"), F.sum(F.col("end") - F.col("start")).alias("characters"))


def without_residue(texts: list[str | None], model: np.ndarray) -> list[tuple[str | None, int]]:
    """(text without its residue, how many characters went) of each text; lines that become blank go too."""
    out: list[tuple[str | None, int]] = []
    for t, spans in zip(texts, find_residue([t or "" for t in texts], model)):
        if not spans:
            out.append((t, 0))
            continue
        kept, at = [], 0
        for s, e, _ in sorted(spans):
            kept.append(t[at : max(s, at)])
            at = max(at, e)
        clean = "\n".join(x for x in re.split("\n", "".join([*kept, t[at:]])) if x.strip())
        out.append((clean, len(t) - len(clean)))
    return out


def clean_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, clean_text, removed) of every row: its text without residue, and how many characters went; null texts stay null."""
    model = df.sparkSession.sparkContext.broadcast(fitted(df, text_col))

    def run(batches):
        for b in batches:
            ids, at = b.column(0), 0
            for texts in _blocks(["" if t is None else t for t in b.column(1).to_pylist()]):
                rows = without_residue(texts, model.value)
                null = b.column(1).slice(at, len(texts)).is_null().to_pylist()
                yield pa.RecordBatch.from_arrays([ids.slice(at, len(texts)), pa.array([None if gone else r[0] for r, gone in zip(rows, null)], pa.string()), pa.array([r[1] for r in rows], pa.int32())], names=["doc_id", "clean_text", "removed"])
                at += len(texts)

    return df.select(F.col(id_col).cast("bigint").alias("doc_id"), text_col).mapInArrow(run, "doc_id bigint, clean_text string, removed int")
