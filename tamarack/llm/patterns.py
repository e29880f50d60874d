"""What stands in place of a page's content, in English, Spanish, German and French.

Patterns but those of slots are for text in lower case, which is much faster than ignoring case.
"""

from __future__ import annotations

import re

# Lines that are an error, script, check, login, loading, maintenance or not-available notice (from the start of a line).
NOTICE_LINES = (
    r"(?:http(?: error)? )?[45]\d\d\b\s*[–—:-]?\s*(?:page not found|not found|forbidden|unauthorized|internal server error|bad gateway|service (?:temporarily )?unavailable|gateway time-?out|too many requests|p[áa]gina no encontrada|seite nicht gefunden|page introuvable|error\b)",
    r"(?:page not found|p[áa]gina no encontrada|seite nicht gefunden|page introuvable|page non trouvée)\W*$",
    r"(?:oops|uups|ups|oups)\W.*(?:found|encontr|gefunden|trouv|wrong)",
    r"we looked everywhere for .* but this page does not exist|it may have been moved or deleted|go back to the home ?page\W*$",
    r"(?:the|this) (?:page|product|document|content|listing|item)s? (?:you (?:requested|are looking for|were looking for) )?(?:is no longer available|does not exist|could not be found|cannot be found|cannot be displayed|was removed|has been removed)",
    r"el contenido que busca ya no existe|la página (?:solicitada|que busca) (?:ya )?no existe|die angeforderte seite ist nicht|die gesuchte seite|la page demandée n['’]existe plus",
    r"(?:internal server error|error interno del servidor|interner serverfehler|erreur interne du serveur|bad gateway|service (?:temporarily )?unavailable|servicio no disponible|gateway time-?out)\W*$",
    r"error establishing a (?:database )?connection|upstream did not answer|the server cannot handle the request|se produjo un error|es ist ein fehler aufgetreten|une erreur est survenue",
    r"(?:código de incidente|incident|request id|référence|reference id|ray id|vorgangsnummer|error id)\b[ :#]*[0-9a-f.\-]{4,}\W*$",
    r"(?:fatal error|parse error|uncaught (?:type|reference|syntax)?error|warning|notice|deprecated): .*(?:undefined|uncaught|unexpected|null|array|function|offset| on line \d)",
    r"traceback \(most recent call last\)|exception in thread",
    r"(?:access denied|acceso denegado|zugriff verweigert|accès refusé|permission denied|forbidden)\W*$|you do not have permission to (?:open|view|access)",
    r"too many requests\W*$|your address sent \d+ requests|demasiadas solicitudes|zu viele anfragen|trop de requêtes",
    r"your session (?:has )?(?:expired|timed out)|su sesión ha (?:expirado|caducado)|ihre sitzung ist abgelaufen|votre session a expiré|(?:please )?log in (?:again )?to (?:continue|view|see)|inicie sesión para|bitte melden sie sich an|veuillez vous connecter",
    r"(?:please )?(?:confirm|verify) that you are (?:not a robot|human)|tick the box below|checking your browser|this takes a few seconds|comprobando su navegador|ihr browser wird geprüft|vérification de votre navigateur",
    r"javascript is (?:disabled|required)|you need to (?:turn on|enable) javascript|(?:please )?enable javascript to|this page cannot be displayed without scripts|debe activar javascript|bitte aktivieren sie javascript, um|ce site nécessite (?:l['’]activation|javascript)|your browser is (?:out of date|not supported)|su navegador (?:está obsoleto|no es compatible)|ihr browser ist veraltet|votre navigateur est obsolète",
    r"(?:loading|please wait|cargando|wird geladen|bitte warten|chargement|veuillez patienter)\s*(?:…|\.{2,3}|!)?$",
    r"site under maintenance|sitio en mantenimiento|wartungsarbeiten\W*$|site en maintenance|our catalogue will be back soon|volveremos pronto|wir sind bald zurück|nous revenons bientôt",
    r"(?:no results|sin resultados|keine ergebnisse|keine treffer|aucun résultat)\W*$|the product you requested is no longer available",
)
NOTICE_LINE = re.compile("|".join(f"(?:{p})" for p in NOTICE_LINES))

# Unfilled slots and failed values, wherever they stand in a line.
SLOTS = (
    r"\{\{[^{}]{1,80}\}\}|\$\{[\w.]{1,80}\}|<%[^%]{1,80}%>|\{%[^%]{1,80}%\}|%%\w{2,60}%%|\(\(\(\w{2,60}\)\)\)|\[\[\w{2,60}\]\]",
    r"\b__[A-Za-z]\w{2,60}|%[A-Z][A-Z_]{2,40}%|@Model\.\w+|\bi18n\.[\w.]+",
    r"\{[a-z]+(?:_[a-z]+)+\}|<[a-z]+(?:_[a-z]+)+>|\[[a-z]+(?:_[a-z]+)+\]",
    r"\[(?i:insert|enter|add|your) [^\]]{1,60}\]|\[[^\]]{1,40} here\]|\[(?i:company|model|product|brand|first|last) ?(?i:name)\]",
    r"[:–]\s*(?:<[a-z]+>|\[[a-z]+\]|\{[a-z]+\})\s*$|^(?:<[a-z]+>|\[[a-z]+\]|\{[a-z]+\})$",
    r"\[object Object\]|#(?:REF|VALUE|NAME|DIV/0|N/A|NUM)[!?]?(?!\w)|\bNaN\b|[:–]\s*(?:undefined|null)\b|^undefined\b|\bundefined undefined\b|\bX{4,}\b|\(replace before publishing\)",
)
SLOT = re.compile("|".join(f"(?:{p})" for p in SLOTS))
#: Signs without which a line has no slot.
MAYBE_SLOT = re.compile(r"[{}\[\]<>$@#_]|\(\(\(|%[A-Z%]|NaN|undefined|null|XXXX|i18n|\(replace")
# A program's message in a text (from the start of a line).
MESSAGE = re.compile(r"(?:fatal error|parse error|uncaught (?:type|reference|syntax)?error|warning|notice|deprecated): .*(?:undefined|uncaught|unexpected|null|array|function|offset| on line )|traceback \(most recent call last\)|exception in thread")
# What notices in place of a page's content speak of, anywhere in a line.
TOPICS = (
    r"not found|can.t be found|does ?n.t exist|does not exist|no longer (?:available|exists?)|moved or deleted|went wrong|no results|home page",
    r"no encontrad[ao]|ya no existe|sin resultados|nicht gefunden|nicht mehr vorhanden|keine (?:ergebnisse|treffer)|introuvable|non trouvée|n.existe (?:plus|pas)|aucun résultat",
    r"\b(?:error|fehler|erreur)\b|bad gateway|gateway time|unavailable|no disponible|nicht verfügbar|indisponible|cannot handle|did not answer|request id|incident|incidente|vorgangsnummer|référence|reference",
    r"denied|forbidden|unauthorized|permission|denegado|verweigert|refusé|too many requests|requests in|demasiadas solicitudes|zu viele anfragen|trop de requêtes",
    r"session|sesión|sitzung|log ?in\b|sign in|inicie sesión|anmelden|connecter",
    r"robot|tick the box|checking your|a few seconds|verify|vérification|comprobando|überprüf|geprüft",
    r"java ?script|\bscripts?\b|browser|navegador|navigateur",
    r"\bloading\b|please wait|cargando|wird geladen|bitte warten|chargement|veuillez patienter|espere",
    r"under maintenance|mantenimiento|wartungsarbeiten|en maintenance|back soon|volveremos|bald zurück|revenons",
)
TOPIC = re.compile("|".join(TOPICS))
WORDS = re.compile(r"[a-záéíóúñüäößàâçèêëîïôûœ]+", re.I)
# Filler text and a template's own instructions, as whole lines.
FILLERS = (
    r"(?:asdf|qwer|test|foo|bla|xxx)(?:[\s\d]+(?:asdf|qwer|test|foo|bla|xxx)){2,}",
    r"sample (?:heading|text|title)\W*$|insert (?:image|text|caption|title)\b.* here|(?:your|add your) text (?:goes )?here|add a short description|this is a (?:demo|sample|placeholder) (?:paragraph|text)|untitled block|click to edit|replace (?:it|this) with your own|todo: ",
    r"hier steht später|platzhaltertext|blindtext|aquí va el texto|texto de (?:relleno|ejemplo)|texte à remplacer|texte d['’]exemple",
)
FILLER = re.compile("|".join(f"(?:{p})" for p in FILLERS))
# Filler wherever it stands in a line.
FILLER_ANYWHERE = re.compile(r"\blorem ipsum\b|\bdummy text\b")
LATIN_FILLER = frozenset("lorem ipsum dolor sit amet consectetur adipiscing elit sed eiusmod tempor incididunt labore dolore magna aliqua enim minim veniam quis nostrud exercitation ullamco laboris nisi aliquip commodo consequat duis aute irure reprehenderit voluptate velit esse cillum fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa officia deserunt mollit anim laborum".split())
