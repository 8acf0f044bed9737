"""Examples of refusals, of their usual companions, and of sound answers.

They are composed by rule from parts that refusals in general are made of, in five
languages; no sentence is taken from a corpus.
"""

from __future__ import annotations

import itertools

_EN_OPEN = ("", "I'm sorry, but ", "Sorry, ", "I am sorry, ", "Unfortunately, ", "I apologize, but ", "Apologies, but ", "I regret that ", "As an AI language model, ", "As a language model, ", "As an AI, ", "As an assistant, ", "I understand your question, but ")
_EN_CANNOT = ("I can't", "I cannot", "I can not", "I am unable to", "I'm unable to", "I'm not able to", "I am not able to", "I won't be able to", "I won't", "I will not", "I am not allowed to", "I'm not permitted to", "I must decline to", "I have to decline to", "I must refuse to", "I must refrain from", "I would rather not", "I'd rather not", "I prefer not to", "I don't feel comfortable", "I do not have the ability to", "I'm not in a position to", "I am not authorized to", "it is not possible for me to", "it would not be appropriate for me to", "it wouldn't be right for me to")
_EN_DO = ("help with that", "help you with this", "assist with that", "assist with this request", "answer that", "answer this question", "answer your question", "answering this question", "provide an answer", "provide an answer to this", "provide that information", "provide advice on this", "give you an answer", "giving advice on that", "fulfil this request", "fulfill that request", "comply with this request", "do that", "do this for you", "discuss this topic", "share that", "explain how to do that", "telling you how to do that", "open or view files", "open or read spreadsheets", "access your file", "work on your workbook", "look at your data", "complete this task")
_EN_WHOLE = (
    "I have to decline this request.", "I must decline this request.", "I have to turn this down.", "Helping with that is something I have to decline.", "This is something I cannot help with.", "That is not something I can help with.", "This request is against my policy.", "This request goes against my guidelines.", "Requests about this topic are against my policy.", "My guidelines do not allow me to answer this.", "Your question cannot be answered under the rules I follow.", "No answer can be given to this question.", "I can offer no solution to this.", "This is beyond what I can help with.", "This is outside what I am able to do.", "That falls outside what I am allowed to do.", "That is beyond my capabilities.", "I have no access to your data.", "I do not have access to your files.", "I'm just an AI and cannot do that.", "I was not built to answer this.", "so I will leave it at that.", "so I will leave it here.",
)
_KO_OPEN = ("", "죄송하지만 ", "죄송합니다. ", "죄송합니다만 ", "안타깝지만 ", "안타깝게도 ", "유감스럽지만 ", "미안하지만 ", "저는 언어 모델이라 ", "저는 인공지능이라서 ", "AI 언어 모델로서 ", "정책상 ", "규정상 ", "지침상 ")
_KO_WHAT = ("이 요청은 ", "해당 요청은 ", "요청하신 내용은 ", "요청하신 작업은 ", "말씀하신 작업은 ", "이 질문에는 ", "해당 질문에는 ", "이 질문에 대해서는 ", "이 내용에 대해서는 ", "그 부분은 ", "파일을 ", "관련 자료에 대해서는 ", "관련 요청은 ", "")
_KO_CANNOT = ("도와드릴 수 없습니다", "도와드리기 어렵습니다", "도움을 드릴 수 없습니다", "도움을 드리지 못합니다", "답변드릴 수 없습니다", "답변을 드릴 수 없습니다", "답변드리기 어렵습니다", "답변이 어렵습니다", "답변할 수 없습니다", "답변이 불가능합니다", "답변이 제한됩니다", "답변이 제한된 질문입니다", "답해 드릴 수 없습니다", "안내해 드릴 수 없습니다", "안내해 드릴 수 없는 점 양해 바랍니다", "안내가 불가능합니다", "제공할 수 없습니다", "제공해 드릴 수 없습니다", "처리할 수 없습니다", "수행할 수 없습니다", "제가 할 수 없습니다", "제가 수행할 수 없습니다", "다룰 수 없습니다", "열어 볼 수 없습니다", "거절합니다", "거절하겠습니다", "거절해야 할 것 같습니다", "대한 답변은 거절해야 합니다", "응할 수 없습니다", "들어드릴 수 없습니다", "제 능력을 벗어납니다", "제 능력 밖입니다", "허용되지 않습니다")
_DE_OPEN = ("", "Es tut mir leid, aber ", "Tut mir leid, ", "Leider ", "Entschuldigung, ", "Als Sprachmodell ", "Als KI ")
_DE_REST = ("kann ich dabei nicht helfen.", "kann ich damit nicht helfen.", "dabei kann ich nicht helfen.", "ich kann Ihnen nicht helfen.", "kann ich diese Frage nicht beantworten.", "ich kann diese Frage nicht beantworten.", "kann ich das nicht tun.", "kann ich das nicht leisten.", "darf ich das nicht beantworten.", "ich darf darauf keine Antwort geben.", "darf ich darauf nicht antworten.", "muss ich diese Anfrage ablehnen.", "diese Anfrage muss ich ablehnen.", "kann ich keine Auskunft geben.", "bin ich nicht in der Lage, das zu tun.", "ist mir das nicht erlaubt.", "ist mir das nicht möglich.")
_FR_OPEN = ("", "Désolé, ", "Je suis désolé, mais ", "Je regrette, ", "Malheureusement, ", "En tant que modèle de langage, ", "En tant qu'IA, ")
_FR_REST = ("je ne peux pas vous aider.", "je ne peux pas t'aider.", "je ne peux pas aider avec cela.", "je ne peux pas répondre à cette question.", "je ne suis pas en mesure de répondre.", "je ne suis pas autorisé à répondre.", "je dois refuser cette demande.", "je dois décliner cette demande.", "il m'est impossible de répondre.", "il m'est impossible de vous aider.", "il m'est impossible d'aider sur ce sujet.", "je ne peux pas faire cela.", "je ne peux pas donner suite à cette demande.", "je préfère ne pas répondre.")
_ES_OPEN = ("", "Lo siento, ", "Lo siento, pero ", "Disculpa, ", "Lamentablemente, ", "Como modelo de lenguaje ", "Como IA ")
_ES_REST = ("no puedo ayudarte con eso.", "no puedo ayudarle con esto.", "no puedo responder a esta pregunta.", "no puedo responder a eso.", "no puedo hacerlo.", "no me es posible responder.", "no me está permitido responder.", "no estoy autorizado a responder.", "debo rechazar esta solicitud.", "tengo que rechazar esta petición.", "no puedo dar una respuesta.", "no puedo atender esta solicitud.", "prefiero no responder.")

#: Sentences that come with a refusal and give no solution either.
COMPANIONS = [
    "Thank you for understanding.", "Thanks for your understanding.", "I hope you understand.", "I appreciate your understanding.", "Is there anything else I can help with?", "Is there something else you would like to know?", "Is there anything else you would like to talk about?", "Feel free to ask me something else.", "Please consult a professional.", "Please consult a qualified professional.", "Please ask an expert.", "Consider asking a specialist instead.", "Please contact support.", "Please contact the vendor.", "Consider contacting the manufacturer.", "This kind of request is not supported.", "Requests of this type are not supported.", "My guidelines do not allow it.", "My rules do not let me give advice on this.", "It may involve private information.", "It could touch on personal data.", "It could cause harm.", "Such instructions could be harmful.", "It could be used in harmful ways.", "It could be misused.", "for safety reasons", "for privacy reasons",
    "양해 부탁드립니다.", "양해 바랍니다.", "양해해 주시기 바랍니다.", "이해해 주셔서 감사합니다.", "이해해 주시기 바랍니다.", "다른 질문이 있으시면 말씀해 주세요.", "다른 궁금한 점이 있으신가요?", "다른 도움이 필요하신가요?", "전문가에게 문의해 주세요.", "전문가와 상담하시기 바랍니다.", "고객센터에 문의해 주세요.", "지원하지 않는 요청입니다.", "지원되지 않는 유형입니다.", "운영 정책에 어긋납니다.", "지침에 따라 답변이 제한됩니다.", "저에게는 필요한 권한이 주어지지 않았습니다.", "개인 정보가 포함되어 있을 수 있습니다.", "개인 정보 보호를 위해서입니다.", "악용될 수 있습니다.", "악용될 우려가 있기 때문입니다.", "위험할 수 있습니다.",
    "Danke für dein Verständnis.", "Vielen Dank für Ihr Verständnis.", "Bitte wenden Sie sich an eine Fachkraft.", "Bitte frag einen Experten.", "Ich habe keinen Zugriff auf deine Daten.", "Mir fehlt der Zugriff auf Ihre Daten.", "Meine Richtlinien erlauben das nicht.", "Das könnte Schaden anrichten.", "Kann ich sonst noch helfen?", "Merci de votre compréhension.", "Merci de consulter un professionnel.", "Veuillez consulter un spécialiste.", "Je n'ai pas accès à vos données.", "Mes règles ne me le permettent pas.", "Cela pourrait être dangereux.", "Puis-je vous aider autrement ?", "Gracias por su comprensión.", "Gracias por tu comprensión.", "Consulta a un profesional.", "Consulte a un especialista.", "No tengo acceso a tus datos.", "Mis normas no me lo permiten.", "Podría ser peligroso.", "¿Puedo ayudarte en otra cosa?",
]

# fixed values: common worksheet functions
_FUNCTIONS = "SUM IF IFERROR IFS INDEX MATCH VLOOKUP HLOOKUP XLOOKUP LOOKUP SUMIF SUMIFS SUMPRODUCT COUNT COUNTA COUNTIF COUNTIFS AVERAGE AVERAGEIF AVERAGEIFS MAX MAXIFS MIN MINIFS LARGE SMALL RANK ROUND ROUNDUP ROUNDDOWN INT MOD ABS TEXT TEXTJOIN CONCAT CONCATENATE LEFT RIGHT MID LEN TRIM CLEAN SUBSTITUTE REPLACE FIND SEARCH PROPER UPPER LOWER VALUE DATE DATEDIF EDATE EOMONTH TODAY NOW YEAR MONTH DAY WEEKDAY WORKDAY NETWORKDAYS OFFSET INDIRECT CHOOSE ROW COLUMN FILTER SORT SORTBY UNIQUE SEQUENCE TRANSPOSE LET LAMBDA AGGREGATE SUBTOTAL ISBLANK ISERROR AND OR NOT RAND".split()
_SHORT = ["Yes", "No", "No, not in that version.", "Yes, that works.", "Works for me", "Done and tested", "Thanks, solved", "That should do it.", "Let me know how it goes.", "Have a nice day", "Good luck", "Hope that helps", "Sorry for the late reply", "Just sort the column by date", "A pivot will do.", "The cell had a blank in it.", "last argument zero", "네 됩니다.", "아니요, 안 됩니다", "피벗으로 하시면 됩니다", "쓰세요.", "날짜순으로 정렬하세요"]
_SHORT_FRAMES = ("Use {f}.", "Try {f}.", "Try {f} with {g}.", "{f} and {g} do it.", "Ctrl+T first, then {f}.", "{f}, last argument zero", "{f} error", "{f} question", "{f} 오류", "{f} 함수 질문", "{f} {g} 차이", "{f} 쓰세요.", "{f} 함수로 됩니다", "Nimm {f}.", "Mit {f} und {g} geht es.", "Avec {f} puis {g}.", "Usa {f}.", "Con {f} y {g}.")
SHORT_ANSWERS = _SHORT * 8 + [s.format(f=f, g=g) for s in _SHORT_FRAMES for f, g in zip(_FUNCTIONS, _FUNCTIONS[7:] + _FUNCTIONS[:7], strict=True)]

#: Everyday explaining prose, so that common words are natural in a small corpus too.
PROSE = [
    "First select the cells that you want to change, then open the menu and choose the option that you need from the list.", "Make sure that there are no empty rows between the headings and the data, because otherwise only a part of them is used.", "If the value in the first column is larger than the one in the second, the result is shown in red, and if not, it stays as it is.", "You can copy the formula down to the end of the table, so it works for all the other rows as well.", "The reason for this is that dates are stored as numbers, and the format only decides how they are shown.", "I had the same thing last week, and in my case it was a blank at the end of the text that made the lookup go wrong.", "That means nothing more than that the name of the file is spelled in another way, so look at the path once more.", "The number in brackets gets replaced by what is in the cell next to it, so leave it alone and let it do its work.", "Write the name in quotation marks and it is filled in by itself as soon as you press the key.", "Your version needs this switched on in the options under trust, then the function loads again when you start it.", "Check the last line of the code, and lock the range with dollar signs before you drag it to the right.", "It is easier to sort the list by date first and to work with a helper column afterwards.", "In the older versions you have to confirm the entry with three keys at once, in the new one that is no longer needed.", "Both lists should start in the same row and have the same length, or the totals will not add up.", "There is no built-in way to do that by color, so most people add a column with a word for each color and count those.", "An add-in of this kind needs scripts switched on in the center of the settings, then its functions load again, and the last one of the list shows up.", "A script in the office version is a kind of JavaScript, so what you want is a loop over the rows and not a formula.", "Thanks for the file, I have put the corrected version on the second sheet and marked what I changed.",
    "먼저 바꾸려는 셀을 선택한 다음 메뉴를 열고 목록에서 필요한 항목을 고르시면 됩니다.", "제목과 자료 사이에 빈 행이 없는지 꼭 확인하세요. 그렇지 않으면 일부만 계산에 들어갑니다.", "첫 번째 열의 값이 두 번째 열보다 크면 빨간색으로 표시되고 아니면 그대로 둡니다.", "수식을 아래로 끝까지 복사하면 다른 행에도 똑같이 적용됩니다.", "날짜가 텍스트로 저장되어 있어서 그런 것이니 숫자로 변환한 뒤에 다시 해 보세요.", "저도 같은 문제가 있었는데 글자 뒤에 공백이 들어 있어서 찾지 못한 것이었습니다.", "표로 바꾸어 두면 자료가 늘어나도 범위가 자동으로 늘어나니 편합니다.", "열기 전에 미리 보기를 누르면 실제 값이 어떻게 나오는지 볼 수 있습니다.",
    "Markiere zuerst die Zellen, die du ändern willst, und wähle dann im Menü den Eintrag aus der Liste.", "Wenn der Wert in der ersten Spalte größer ist als in der zweiten, wird er rot angezeigt, sonst bleibt er so, wie er ist.", "Sélectionnez d'abord les cellules à modifier, puis choisissez dans le menu l'option dont vous avez besoin.", "Si la valeur de la première colonne est plus grande que celle de la deuxième, elle s'affiche en rouge, sinon elle reste comme elle est.", "Primero selecciona las celdas que quieres cambiar y luego elige en el menú la opción que necesitas.", "Si el valor de la primera columna es mayor que el de la segunda, se muestra en rojo, y si no, se queda como está.",
]


def refusal_texts() -> list[str]:
    english = [o + c + " " + d + "." for o, c, d in itertools.product(_EN_OPEN, _EN_CANNOT, _EN_DO)]
    korean = [o + w + c + "." for o, w, c in itertools.product(_KO_OPEN, _KO_WHAT, _KO_CANNOT)]
    others = [o + r for opens, rests in ((_DE_OPEN, _DE_REST), (_FR_OPEN, _FR_REST), (_ES_OPEN, _ES_REST)) for o, r in itertools.product(opens, rests)]
    # a language weighs by what it says, not by how many parts there are to compose
    return english[::3] + korean[::2] + others * 6 + list(_EN_WHOLE) * 60
