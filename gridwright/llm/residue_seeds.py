"""Examples of leftover text that the residue models are fitted to.

Everything here is example text of general knowledge: what widespread servers, browsers,
languages and content systems say, and what people leave where content is still to come.
None of it is taken from a corpus; the wording of a corpus's own leftovers is learned from
what these examples find.  Keyboard mash is drawn from a seeded generator.
"""

from __future__ import annotations

import itertools
import random
from http import HTTPStatus

# fixed values: words of the pseudo-Latin filler text
LATIN = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum massa urna lacus risus porta quam"

_KINDS = ("text", "title", "content", "answer", "description", "heading", "body", "name", "post", "message")
_KINDS_KO = ("제목", "내용", "본문", "텍스트", "답변", "설명", "글", "데이터", "문장")
_FILLER_FRAMES = ("Your {k} here", "Your {k} goes here", "{k} goes here", "Insert {k} here", "Add your {k} here", "Enter {k} here", "Type your {k} here", "Replace this {k}", "Replace with your own {k}", "This is placeholder {k}", "Placeholder {k}", "Dummy {k}", "Sample {k}", "Example {k}", "Test {k}", "Default {k}", "{k} {k} {k}", "TODO: write {k}", "TODO add {k}", "{k} to be added", "{k} coming soon")
_FILLER_FRAMES_KO = ("여기에 {k} 입력", "여기에 {k}을 입력하세요", "여기에 {k}를 입력하세요", "{k}을 입력하세요", "{k}를 입력해 주세요", "{k}을 넣어 주세요", "{k} 예시", "예시 {k}입니다", "샘플 {k}입니다", "샘플 {k}", "더미 {k}", "임시 {k}입니다", "임시 {k}", "테스트 {k}입니다", "테스트 {k}", "{k} 테스트", "{k}이 들어갑니다", "{k}이 들어갈 자리입니다", "{k} 작성 예정", "{k} 추가 예정")
FILLER = [
    "Coming soon", "Coming soon...", "to be continued", "to be completed", "to be added", "to be written", "to be determined", "under construction", "work in progress", "TBD", "TBA", "FIXME", "TODO", "TODO fill in later", "FIXME fill this in", "fill me in", "fill in later", "will be filled in later", "replace me", "replace before publishing", "delete me", "remove this before going live", "do not publish", "draft, do not publish", "no content", "no content yet", "nothing here yet", "undefined", "untitled", "untitled document", "New page", "new post", "Hello world!", "Welcome to WordPress. This is your first post. Edit or delete it, then start writing!", "This is an example page.", "Just another WordPress site",
    "test test test", "test 1 2 3", "testing testing 1 2 3", "this is a test", "this is only a test, please ignore", "test post please ignore", "please ignore this test", "blah blah blah blah", "foo bar baz", "foo bar", "abc abc abc", "asdf asdf", "qwerty qwerty", "xxx xxx xxx", "xxxx xxxx xxxxx", "yada yada yada", "1234 test",
    "추후 작성 예정", "추후 업데이트 예정", "나중에 작성", "나중에 채우기", "작성 예정입니다", "작성 중입니다", "준비 중입니다", "업데이트 예정입니다", "테스트 테스트 테스트", "테스트입니다", "테스트 글입니다 무시하세요", "테스트 중입니다", "무시하세요", "무시해 주세요", "제목 없음", "내용 없음", "내용 무", "가나다라 마바사", "가나다라마바사 아자차카타파하", "게시 전 수정 필요", "게시하지 마세요", "임시 저장", "임시 저장된 글입니다",
    "Platzhaltertext", "Platzhalter", "Blindtext", "Mustertext", "Hier steht Ihr Text", "Text hier einfügen", "Hier Text eingeben", "Folgt in Kürze", "Texte d'exemple", "Texte provisoire", "Votre texte ici", "À compléter", "À venir", "Texto de ejemplo", "Texto de prueba", "Su texto aquí", "Contenido de prueba", "Próximamente", "Pendiente de completar",
]

ERRORS = [
    "Page not found", "404 page not found", "The page you are looking for could not be found.", "The page you requested does not exist.", "The requested page does not exist", "The requested URL was not found on this server.", "The address you entered does not exist", "No such page", "File not found.", "Access denied", "Access to this page has been denied", "Permission denied", "You don't have permission to access this resource.", "You do not have permission to view this page", "You have been blocked", "Your IP address has been blocked", "Your address has been logged", "Sorry, you have been rate limited", "You have been rate limited. Please slow down.", "Too many requests. Try again later.", "Rate limit exceeded", "Request blocked",
    "An error occurred while processing your request.", "The server encountered an internal error or misconfiguration and was unable to complete your request.", "The server is temporarily unable to service your request due to maintenance downtime or capacity problems.", "The server is temporarily unavailable", "The server did not respond in time.", "The server did not answer in time", "The server took too long to respond.", "The proxy server received an invalid response from an upstream server.", "Error connecting to the server", "Something went wrong", "Oops! Something went wrong", "Whoops, looks like something went wrong.", "Oops! An error occurred", "An unexpected error has occurred", "An unknown error has occurred", "We are sorry, but something went wrong.", "There was an error loading this page", "Failed to load resource", "Failed to fetch", "Please try again later.", "Please try again in a few minutes.", "Please check the address and try again.", "Check the address and reload the page", "Please reload the page", "Go back to the start page.", "Back to the home page", "Return to the homepage", "If the problem persists, contact the administrator.", "If this problem persists, please contact the webmaster", "Please contact the site administrator", "write to the administrator",
    "This page can't be displayed", "This page isn't working", "This site can't be reached", "This page can’t be found", "took too long to respond", "refused to connect", "Unable to connect", "The connection has timed out", "Connection timed out", "Connection refused", "Connection reset by peer", "Connection was reset", "The connection was reset while the page was loading", "Connection reset while reading response header from upstream", "upstream timed out while reading response header from upstream", "upstream prematurely closed connection", "upstream closed the connection", "no live upstreams", "no healthy upstream", "upstream connect error or disconnect/reset before headers", "peer closed the connection", "Server not found", "DNS lookup failed", "Could not resolve host", "Read timed out", "request timed out", "TimeoutError: the request took too long", "TimeoutError: timed out", "no reply after 30s", "no response after 30 seconds", "ConnectionError: connection refused", "ConnectionResetError", "fatal error: uncaught exception", "Error establishing a database connection", "Unable to connect to the database", "Could not connect to the database server", "Database error", "SQL error: syntax error near", "You have an error in your SQL syntax", "SQLSTATE[42000]: syntax error or access violation", "SQL error: table is locked", "database is locked", "table is locked", "Lock wait timeout exceeded; try restarting transaction", "deadlock found when trying to get lock", "Too many connections", "disk quota exceeded", "out of memory",
    "Warning: Undefined variable in index.php on line 3", "Warning: undefined array key in index.php on line 12", "Notice: Undefined index: id in page.php on line 8", "Notice: undefined index in page.php on line 77", "Fatal error: Call to undefined function in index.php on line 20", "Parse error: syntax error, unexpected end of file in index.php on line 1", "Warning: Cannot modify header information - headers already sent", "Deprecated: Function is deprecated in file.php on line 5", "Traceback (most recent call last): File", "NullPointerException", "java.lang.NullPointerException at", "Exception in thread main", "System.NullReferenceException: Object reference not set to an instance of an object", "Unhandled exception", "TypeError: undefined is not a function", "Uncaught TypeError: Cannot read properties of undefined", "Internal error", "Error code 1020", "Error 1015", "Error reference number", "Segmentation fault",
    "Site under maintenance", "Site is down for maintenance, back soon", "We'll be back soon!", "We are currently performing scheduled maintenance", "We are down for maintenance", "Scheduled maintenance until 03:00", "Briefly unavailable for scheduled maintenance. Check back in a minute.", "Your session has expired. Please log in again.", "Session expired", "Session timed out", "Invalid session", "Your login has expired", "Please sign in to continue", "You must be logged in to view this page", "You need to log in to view this content", "Login required", "This post has been deleted", "This post has been removed", "This content is no longer available", "This content is not available", "This page has been removed", "This item no longer exists", "Video unavailable", "This link has expired",
    "Just a moment...", "Checking your browser before accessing", "Just a moment, checking your browser", "we are checking your browser", "Please wait while we check your browser", "Please wait while we verify your request", "Verify you are human by completing the action below", "Please verify that you are not a robot", "confirm that you are not a robot", "One more step: please complete the security check to access", "Complete the captcha to continue", "Performing security verification", "Attention Required!", "DDoS protection by", "Unusual traffic from your computer network",
    "페이지를 찾을 수 없습니다", "요청하신 페이지를 찾을 수 없습니다", "요청하신 페이지가 존재하지 않습니다", "존재하지 않는 페이지입니다", "존재하지 않는 게시물입니다", "존재하지 않는 글입니다", "삭제된 게시물입니다", "삭제되었거나 존재하지 않는 게시물입니다", "삭제되었거나 이동된 페이지입니다", "게시글이 삭제되었습니다", "잘못된 접근입니다", "잘못된 요청입니다", "잘못된 경로입니다", "비정상적인 접근입니다", "접근 권한이 없습니다", "권한이 없습니다", "접근이 거부되었습니다", "접근이 제한되었습니다", "서버에서 오류가 발생했습니다", "서버 오류가 발생했습니다", "서버 내부 오류입니다", "서버에 연결할 수 없습니다", "서버가 응답하지 않습니다", "일시적인 오류가 발생했습니다", "일시적인 장애가 발생했습니다", "알 수 없는 오류가 발생했습니다", "오류가 발생했습니다", "오류 코드 500", "에러가 발생했습니다", "연결 시간이 초과되었습니다", "응답 시간이 초과되었습니다", "요청 시간이 초과되었습니다", "네트워크 오류가 발생했습니다", "데이터베이스에 연결할 수 없습니다", "데이터베이스 오류", "서비스 점검 중입니다", "시스템 점검 중입니다", "서버 점검 중입니다", "서비스 이용에 불편을 드려 죄송합니다", "세션이 만료되었습니다", "로그인 세션이 만료되었습니다", "다시 로그인해 주세요", "로그인이 필요합니다", "로그인 후 이용해 주세요", "회원만 볼 수 있습니다", "잠시 후 다시 시도해 주세요", "잠시 후 다시 시도해 주시기 바랍니다", "나중에 다시 시도해 주세요", "관리자에게 문의하세요", "관리자에게 문의해 주시기 바랍니다", "메인 페이지로 이동합니다", "메인으로 돌아가기", "이전 페이지로 돌아갑니다", "주소를 다시 확인해 주세요", "주소가 올바른지 확인해 주세요", "잠시만 기다려 주세요", "브라우저를 확인하고 있습니다", "브라우저를 확인하는 중입니다", "자동 접속이 아닌지 확인하고 있습니다", "로봇이 아닙니다", "로봇이 아님을 확인해 주세요", "자동 등록 방지", "요청이 너무 많습니다", "이용이 제한되었습니다", "비공개 게시글입니다", "서비스가 종료되었습니다",
    "Seite nicht gefunden", "Die angeforderte Seite wurde nicht gefunden", "Zugriff verweigert", "Interner Serverfehler", "Ein Fehler ist aufgetreten", "Bitte versuchen Sie es später erneut", "Wartungsarbeiten", "Sitzung abgelaufen", "Page introuvable", "La page demandée n'existe pas", "Accès refusé", "Erreur interne du serveur", "Une erreur est survenue", "Veuillez réessayer plus tard", "Site en maintenance", "Session expirée", "Página no encontrada", "La página solicitada no existe", "Acceso denegado", "Error interno del servidor", "Se ha producido un error", "Inténtelo de nuevo más tarde", "Sitio en mantenimiento", "La sesión ha caducado",
]

_EN_ACT = ("enable", "activate", "allow", "turn on", "switch on", "unblock")
_EN_WHAT = ("JavaScript", "JS", "scripts", "scripting", "active scripting", "JavaScript and cookies", "scripts and cookies")
_EN_FRAME = ("Please {a} {w}{t}", "You need to {a} {w}{t}", "You must {a} {w}{t}", "{a} {w}{t}", "This site requires you to {a} {w}{t}", "To continue, {a} {w}{t}")
_EN_TAIL = (" to view this page.", " to continue.", " to use this site.", " in your browser.", " in your browser settings.", " for this site.", " and reload the page.", " and try again.", " to see the content.", ", it is turned off.")
_EN_FIXED = ["JavaScript is required", "JavaScript is required to view this page", "JavaScript is disabled", "JavaScript is disabled in your browser", "JavaScript is not available.", "This page requires JavaScript", "This site requires JavaScript to work", "This app works best with JavaScript enabled", "You need to enable JavaScript to run this app.", "Your browser does not support JavaScript", "Your browser does not support scripts or has them blocked", "Scripts are disabled, so this content cannot be loaded", "The content cannot be loaded without scripts", "before the content can load", "noscript", "You have JavaScript turned off", "JavaScript seems to be disabled in your browser", "Please turn JavaScript on and reload the page.", "Bitte aktivieren Sie JavaScript", "Diese Seite benötigt JavaScript", "Veuillez activer JavaScript", "Ce site nécessite JavaScript", "Active JavaScript para continuar", "Este sitio requiere JavaScript", "자바스크립트를 지원하지 않는 브라우저입니다", "자바스크립트를 사용할 수 없습니다", "자바스크립트가 비활성화되어 있습니다", "브라우저에서 스크립트를 지원하지 않습니다", "브라우저에서 스크립트가 차단되어 있습니다", "스크립트가 차단되어 내용을 표시할 수 없습니다"]
_KO_HEAD = ("이 페이지를 보려면", "이 사이트를 이용하려면", "내용을 보려면", "내용을 표시하려면", "계속하려면", "서비스를 이용하시려면", "정상적인 이용을 위해")
_KO_WHAT = ("JavaScript", "자바스크립트", "스크립트", "스크립트와 쿠키", "브라우저의 스크립트 기능")
_KO_TAIL = ("사용이 필요합니다", "활성화가 필요합니다", "켜 주세요", "활성화해 주세요", "사용 설정해 주세요", "설정을 확인해 주세요", "차단을 해제해 주세요", "허용해 주세요", "설정 후 새로고침하세요")


def filler() -> list[str]:
    """Short filler, also repeated, and with a running number."""
    framed = [f.format(k=k) for f, k in itertools.product(_FILLER_FRAMES, _KINDS)] + [f.format(k=k) for f, k in itertools.product(_FILLER_FRAMES_KO, _KINDS_KO)]
    return [form.format(t=t) for t in framed + FILLER * 4 for form in ("{t}", "{t} 1", "{t}. {t}.", "{t} {t}")]


def errors() -> list[str]:
    """Messages of servers, among them each status of the HTTP standard as it is usually shown."""
    statuses = [form.format(n=s.value, t=s.phrase) for s in HTTPStatus if s.value >= 400 for form in ("{n} {t}", "HTTP {n}: {t}", "Error {n}: {t}", "HTTP Error {n} - {t}", "{t}")]
    return [form.format(t=t) for t in ERRORS * 3 + statuses for form in ("{t}", "{t}.", "{t} {t}")]


def script_notices() -> list[str]:
    out = [f.format(a=a, w=w, t=t) for a, w, t, f in itertools.product(_EN_ACT, _EN_WHAT, _EN_TAIL, _EN_FRAME)]
    return out + [" ".join(x) for x in itertools.product(_KO_HEAD, _KO_WHAT, _KO_TAIL)] + _EN_FIXED * 8


def latin_filler(words: int = 6000) -> str:
    draw = random.Random(7)
    return " ".join(draw.choice(LATIN.split()) for _ in range(words))


def keyboard_mash(letters: str, size: int = 40_000) -> str:
    """Words struck at random on some keys."""
    draw = random.Random(11)
    return "".join(" " if draw.random() < 0.15 else draw.choice(letters) for _ in range(size))


def seeds() -> dict[str, list[str]]:
    """Example texts by model."""
    return {
        "filler": filler(),
        "latin": [latin_filler()],
        "mash_home": [keyboard_mash("asdfghjkl")],
        "mash_top": [keyboard_mash("qwertyuiop")],
        "mash_hangul": [keyboard_mash("ㄱㄴㄷㄹㅁㅂㅅㅇㅈㅊㅋㅌㅍㅎ")],
        "error": errors(),
        "script": script_notices(),
    }
