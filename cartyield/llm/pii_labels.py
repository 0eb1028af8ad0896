"""A small labelled table for personal data: sentences with the spans marked."""

# Sentences written for this table. <kind:...> marks a span of that kind.
SENTENCES: list[str] = [
    "write to <email:ann.lee@mail.example.com> by noon",
    "mail <email:joe_99@corp.example.org>, please",
    "my address is <email:k.o'neil@mail.example.com> and yours is not",
    "contact: <email:info@shop.example.net>; thanks",
    "send it to <email:maria (at) mail.example.com> today",
    "reach me at <email:tom [at] web.example.org> or by post",
    "écrivez à <email:léa.roux@courrier.example.fr> demain",
    "Bitte an <email:jörg.weiß@post.example.de> senden",
    "the mail <email:x.23@mail3.example.com> reached us",
    "he wrote <email:paul.22@web1.example.com> de la",
    "the host <ip:10.1.22.3> is down",
    "from <ip:192.168.0.17> to <ip:172.16.4.250> again",
    "login by <ip:203.0.113.77>, port closed",
    "le serveur <ip:198.51.100.4> ne répond pas",
    "der Rechner <ip:191.26.250.130> ist aus",
    "blocked <ip:8.8.4.4>. Then it came back",
    "host <ip:2001:db8::8a2e:370:7334> is new",
    "ping <ip:fe80::1ff:fe23:4567:890a> failed",
    "pay with <card:4111 1111 1111 1111> now",
    "card <card:5500-0000-0000-0004> was refused",
    "the number <card:4012888888881881> is on the bill",
    "she gave <card:378282246310005> to the clerk",
    "tarjeta <card:6011 1111 1111 1117> de la casa",
    "Karte <card:3530111333300000> ist neu",
    "call <phone:+1 (555) 010-6973> after six",
    "phone <phone:+49 30 901820> or come by",
    "tel <phone:+33 1 70 18 99 00>, merci",
    "ring <phone:+44-20-7946-0991> soon",
    "de <phone:+1 (509) 555-6973> a la",
    "call <phone:(555) 010-4477> after six",
    "her phone is <phone:555-010-2233> at work",
    "telefon <phone:030 901820> im Büro",
    "tel <phone:01 70 18 99 00>, merci",
    "the fax <phone:+39.06.6982> is old",
    "it happened on 2024-05-17 at 10:30",
    "am 17.05.2024 war es kalt",
    "version 2.0.14 came out in 2023",
    "section 4.2.1 of the text says so",
    "order 88213 has 14 parts for 12.50 each",
    "the order 2994256256331784 went out",
    "number 0826257060216530 was never used",
    "ticket 7086638319846192 is closed",
    "a total of 1,250,000 people in 1999",
    "from 1914 to 1918 and 1939-1945",
    "pages 12-19 and 101-110 are lost",
    "token = \"186661156f3f9905942d70850a01cbf23a203f82\" was found",
    "key = \"254ca002228af484f240146ffd26ba4415598ee8\" is secret",
    "see http://www.example.com/a/b.html for more",
    "follow @someone or @another on it",
    "at 3 pm we met at the inn",
    "the sum (12) and the rest (34) are even",
    "x = 3.14 and y = 2.72 are near",
    "| 12 | 45 | 7.5 | 80 | in the table",
    "de la casa en el año 1990 y no más",
    "le chat est là, et puis voilà.",
    "Der Hund ist da. Und die Katze auch!",
    "nothing*** here### is&&& of%%% use$$$ now",
    "this work is licensed under version 3.",
    "Licensed under CC BY-NC 4.0.",
    "the. Of the and in to a is that it was for",
]
