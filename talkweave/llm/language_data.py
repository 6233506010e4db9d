"""Fixed values for language identification: label notations and a seed text per language."""

from __future__ import annotations

LANGUAGES = ["de", "en", "es", "fr", "it", "nl", "pl", "pt", "ru"]

#: Notations of labels: ISO 639-1, ISO 639-2, English and own names. Regions after - or _ are cut off before.
LABELS = {
    notation: lang
    for lang, notations in {
        "de": "de deu ger german deutsch",
        "en": "en eng english",
        "es": "es spa spanish español espanol castellano",
        "fr": "fr fra fre french français francais",
        "it": "it ita italian italiano",
        "nl": "nl nld dut dutch nederlands flemish",
        "pl": "pl pol polish polski",
        "pt": "pt por portuguese português portugues",
        "ru": "ru rus russian русский",
    }.items()
    for notation in notations.split()
}

#: Where training starts from: everyday sentences of our own, with the commonest words of each language.
SEED = {
    "de": "Wir haben uns gestern im Büro getroffen und lange über die Arbeit gesprochen. Ich weiß nicht, ob das noch geht, aber man kann es ja versuchen. Die Kinder sind heute nicht in der Schule, weil sie krank waren. Das ist eine sehr gute Frage, und niemand hat eine Antwort darauf. Es gibt viele Leute, die auch noch etwas sagen wollen, bevor wir nach Hause gehen. Können Sie mir bitte zeigen, wie man zum Bahnhof kommt? Vielen Dank für Ihre Hilfe, das war wirklich sehr freundlich. Der neue Plan wird erst im nächsten Jahr fertig sein. Sie hat mir einen Brief geschrieben, aber ich habe ihn nie bekommen. Am Morgen war es kalt, doch am Abend schien wieder die Sonne über dem Fluss.",
    "en": "We met in the office yesterday and talked for a long time about the work. I do not know whether that is still possible, but you can always try it. The children are not at school today because they were ill. This is a very good question and nobody has an answer to it. There are many people who would also like to say something before we go home. Could you please show me how to get to the station? Thank you very much for your help, that was really kind of you. The new plan will not be ready until next year. She wrote me a letter, but I have never received it. It was cold in the morning, yet in the evening the sun was shining over the river again.",
    "es": "Ayer nos vimos en la oficina y hablamos mucho tiempo del trabajo. No sé si eso todavía es posible, pero siempre se puede intentar. Los niños no están hoy en la escuela porque estaban enfermos. Es una pregunta muy buena y nadie tiene una respuesta. Hay mucha gente que también quiere decir algo antes de que nos vayamos a casa. ¿Me podría enseñar cómo se llega a la estación, por favor? Muchas gracias por su ayuda, ha sido muy amable. El nuevo plan no estará listo hasta el año que viene. Ella me escribió una carta, pero nunca la he recibido. Por la mañana hacía frío, y por la tarde el sol brillaba otra vez sobre el río.",
    "fr": "Hier nous nous sommes vus au bureau et nous avons longtemps parlé du travail. Je ne sais pas si c’est encore possible, mais on peut toujours essayer. Les enfants ne sont pas à l’école aujourd’hui parce qu’ils étaient malades. C’est une très bonne question et personne n’a de réponse. Il y a beaucoup de gens qui veulent aussi dire quelque chose avant que nous rentrions chez nous. Pourriez-vous me montrer comment aller à la gare, s’il vous plaît ? Merci beaucoup pour votre aide, c’était vraiment gentil. Le nouveau plan ne sera prêt que l’année prochaine. Elle m’a écrit une lettre, mais je ne l’ai jamais reçue. Le matin il faisait froid, et le soir le soleil brillait de nouveau sur la rivière.",
    "it": "Ieri ci siamo visti in ufficio e abbiamo parlato a lungo del lavoro. Non so se sia ancora possibile, ma si può sempre provare. I bambini oggi non sono a scuola perché erano malati. È una domanda molto buona e nessuno ha una risposta. Ci sono molte persone che vogliono dire ancora qualcosa prima di andare a casa. Mi può mostrare come si arriva alla stazione, per favore? Grazie mille per il suo aiuto, è stato davvero gentile. Il nuovo piano sarà pronto solo l’anno prossimo. Lei mi ha scritto una lettera, ma non l’ho mai ricevuta. Al mattino faceva freddo, e la sera il sole splendeva di nuovo sul fiume.",
    "nl": "Gisteren hebben we elkaar op kantoor gezien en lang over het werk gepraat. Ik weet niet of dat nog kan, maar je kunt het altijd proberen. De kinderen zijn vandaag niet op school, omdat ze ziek waren. Dat is een heel goede vraag en niemand heeft er een antwoord op. Er zijn veel mensen die ook nog iets willen zeggen voordat we naar huis gaan. Kunt u mij alstublieft laten zien hoe ik bij het station kom? Hartelijk dank voor uw hulp, dat was echt heel aardig. Het nieuwe plan is pas volgend jaar klaar. Zij heeft mij een brief geschreven, maar ik heb hem nooit gekregen. In de ochtend was het koud, maar in de avond scheen de zon weer boven de rivier.",
    "pl": "Wczoraj spotkaliśmy się w biurze i długo rozmawialiśmy o pracy. Nie wiem, czy to jeszcze jest możliwe, ale zawsze można spróbować. Dzieci nie są dzisiaj w szkole, ponieważ były chore. To jest bardzo dobre pytanie i nikt nie zna odpowiedzi. Jest wielu ludzi, którzy też chcą coś powiedzieć, zanim pójdziemy do domu. Czy może mi pan pokazać, jak dojść do dworca? Bardzo dziękuję za pomoc, to było naprawdę miłe. Nowy plan będzie gotowy dopiero w przyszłym roku. Ona napisała do mnie list, ale nigdy go nie dostałem. Rano było zimno, a wieczorem słońce znowu świeciło nad rzeką.",
    "pt": "Ontem encontrámo-nos no escritório e falámos muito tempo sobre o trabalho. Não sei se isso ainda é possível, mas pode-se sempre tentar. As crianças não estão hoje na escola porque estavam doentes. É uma pergunta muito boa e ninguém tem uma resposta. Há muitas pessoas que também querem dizer alguma coisa antes de irmos para casa. Pode mostrar-me como se chega à estação, por favor? Muito obrigado pela sua ajuda, foi muito simpático. O novo plano só vai estar pronto no próximo ano. Ela escreveu-me uma carta, mas eu nunca a recebi. De manhã estava frio, e à noite o sol brilhava outra vez sobre o rio.",
    "ru": "Вчера мы встретились в бюро и долго говорили о работе. Я не знаю, можно ли это ещё сделать, но всегда можно попробовать. Дети сегодня не в школе, потому что они были больны. Это очень хороший вопрос, и никто не знает ответа. Есть много людей, которые тоже хотят что-то сказать, прежде чем мы пойдём домой. Покажите мне, пожалуйста, как дойти до вокзала. Большое спасибо за вашу помощь, это было очень любезно. Новый план будет готов только в следующем году. Она написала мне письмо, но я его так и не получил. Утром было холодно, а вечером солнце снова светило над рекой.",
}
