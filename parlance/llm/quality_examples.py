"""Texts whose class was judged by reading them: prose in other scripts, languages and fields than the rules of
inspected_examples make, and lists, tables and junk as they stand in mails, wikis and logs. All are our own."""

#: Fixed values: (class, kind, text).
LOOKED_AT = [
    ("prose", "scripts", "昨天下午我们在会议室讨论了新的计划。大家都认为时间太紧，所以决定把截止日期推迟两个星期。会后，小组又检查了一遍预算，发现还有一些项目没有算进去。"),
    ("prose", "scripts", "春天来了，河边的树都绿了。孩子们放学以后常常在那里玩，一直到天黑才回家。"),
    ("prose", "scripts", "会議は午前十時に始まり、新しい予算について話し合いました。多くの人が賛成しましたが、いくつかの質問がまだ残っています。次の会議までに資料を準備することになりました。"),
    ("prose", "scripts", "駅の近くに小さな本屋があります。店の人はとても親切で、いつも面白い本をすすめてくれます。"),
    ("prose", "scripts", "오늘 회의에서는 새로운 일정에 대해 이야기했습니다. 모두가 동의했지만 예산은 다음 주에 다시 검토하기로 했습니다. 그래서 보고서는 조금 늦어질 것입니다."),
    ("prose", "scripts", "Вчера мы обсудили новый план и решили перенести срок на две недели. Никто не возражал, но вопрос о бюджете остался открытым. К следующей встрече надо подготовить отчёт."),
    ("prose", "scripts", "Старый мост закрыли ещё весной, поэтому теперь все ездят через соседнюю деревню. Дорога там узкая, и по утрам часто приходится ждать."),
    ("prose", "scripts", "Χθες συζητήσαμε το νέο σχέδιο και αποφασίσαμε να το αφήσουμε για αργότερα. Κανείς δεν είχε αντίρρηση, αλλά ο προϋπολογισμός έμεινε ανοιχτός."),
    ("prose", "scripts", "ناقشنا أمس الخطة الجديدة وقررنا تأجيل الموعد أسبوعين. لم يعترض أحد، لكن مسألة الميزانية بقيت مفتوحة حتى الاجتماع القادم."),
    ("prose", "scripts", "कल हमने नई योजना पर चर्चा की और समय सीमा दो सप्ताह बढ़ाने का निर्णय लिया। किसी ने विरोध नहीं किया, लेकिन बजट का सवाल अब भी खुला है।"),
    ("prose", "languages", "Wczoraj omówiliśmy nowy plan i postanowiliśmy przesunąć termin o dwa tygodnie. Nikt się nie sprzeciwił, ale sprawa budżetu została na później."),
    ("prose", "languages", "I går gick vi igenom den nya planen och bestämde att flytta fram datumet två veckor. Ingen hade något emot det, men frågan om pengarna är fortfarande öppen."),
    ("prose", "languages", "Ieri abbiamo discusso il nuovo piano e abbiamo deciso di spostare la scadenza di due settimane. Nessuno si è opposto, ma la questione del bilancio resta aperta."),
    ("prose", "languages", "Gisteren bespraken we het nieuwe plan en besloten we de datum twee weken op te schuiven. Niemand had bezwaar, maar over het geld moeten we het nog hebben."),
    ("prose", "languages", "Ontem discutimos o novo plano e decidimos adiar o prazo por duas semanas. Ninguém se opôs, mas a questão do orçamento continua em aberto."),
    ("prose", "languages", "Dün yeni planı konuştuk ve süreyi iki hafta uzatmaya karar verdik. Kimse karşı çıkmadı, ama bütçe konusu hâlâ açık."),
    ("prose", "languages", "Eilen kävimme läpi uuden suunnitelman ja päätimme siirtää määräaikaa kahdella viikolla. Kukaan ei vastustanut, mutta budjetti jäi vielä auki."),
    ("prose", "technical", "The client first calls https://api.example.org/v2/items?limit=50 and reads the `next` field of the answer. If it is missing, the loop ends; otherwise the call is repeated with the new offset. Set RETRY_MAX to 3 in /etc/loader/config.toml before you run it."),
    ("prose", "technical", "To build the package, run `make all` and then copy dist/app-1.4.2.tar.gz to the server. See http://docs.example.com/install#linux for the flags. The tests need about 2 GB of RAM and take 15 minutes on a laptop."),
    ("prose", "technical", "With HTTP/2 the server may push files before they are asked for. In our tests (Chrome 118, 40 ms RTT) this cut the load time from 1.9 s to 1.4 s, see www.example.net/bench for the raw numbers."),
    ("prose", "technical", "The function parse_row(line, sep=',') returns a tuple, or None when the line has fewer than MIN_COLS cells. It never raises ValueError, so callers should check for None themselves."),
    ("prose", "technical", "The error E0425 means that a name is not in scope. Usually a `use` line is missing; add it at the top of src/main.rs and compile again."),
    ("list", "lines", "milk\nrye bread\ntwo lemons\nwashing powder\ncandles\nstring"),
    ("list", "lines", "Things to pack:\n- warm socks\n- torch\n- maps\n- first aid kit\n- rope, 20 m"),
    ("list", "lines", "1) paint the fence\n2) call the plumber\n3) new filter\n4) sort the shed"),
    ("table", "tabs", "name\tdesk\tphone\nKim\t4\t118\nJo\t7\t120\nAl\t9\t131\nSam\t2\t144"),
    ("table", "piped", "| day | open | close |\n|---|---|---|\n| Mon | 9 | 17 |\n| Tue | 9 | 18 |\n| Wed | 10 | 17 |"),
    ("junk", "encoded", "iVBORw0KGgoAAAANSUhEUgAAAAUAAAAFCAYAAACNbyblAAAAHElEQVQI12P4//8/w38GIAXDIBKE0DHxgljNBAAO9TXL0Y4OHwAAAABJRU5ErkJggg=="),
    ("junk", "page", "Home | About | Contact | Login\nAccept cookies | Reject all | Settings\nShare | Tweet | Pin it\n© All rights reserved\nBack to top"),
    ("junk", "letters", "sdkfj wlekr sdlkfj qwpoe zxmnc bvqwk rjtyh plkmn gfdsw xcvbn qwrtp lkjhg fdsaz"),
]
