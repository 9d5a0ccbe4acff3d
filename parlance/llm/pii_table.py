"""The labelled table of problem 7: sentences with typed slots, and rules that fill and vary them.

Each sentence is a row; a slot {type} stands for a passage of that type. Names, numbers and places are made up.
The sentences are our own and not taken from the tables the field is applied to.
"""

from __future__ import annotations

import random

#: Labelled sentences with personal data, by language.
MARKED = """
Please loop in {name} before we sign anything.
I had coffee with {name} and it went well.
We are waiting on {name} to confirm the budget.
Let me introduce {name}, our new colleague.
Hello everyone, {name} here, can you hear me?
Hi {given}, how was the trip?
Thank you {given}, that helps a lot.
Thanks, {given}. Next question please.
Over to you, {given}.
{given}, could you share your screen?
{name} mentioned that the supplier was late.
{name} will present the figures tomorrow.
{name} joined late and left early.
{name} is out sick this week.
{name} agreed, but only for a month.
{name} wants another round of tests.
{given} asked whether we could wait.
{given} thinks it is too early.
{given} promised to send it by noon.
{given} was not in the room.
{given} told me about it yesterday.
{given} and {given} share one office.
Can {given} handle the rest?
Has {name} seen this yet?
Did {given} reply to you?
Maybe {given} knows more.
The idea came from {name} originally.
A note by {name} explains the change.
It was signed by {name} and {name}.
Drafted by {name}, checked by {name}.
We hired {name} in the spring.
According to {name}, nothing has changed.
I would ask {name} first.
I will talk to {given} about that.
Reach out to {name} if it breaks.
Give the folder to {given} when you are done.
Forward it to {name} and to nobody else.
Attendees: {name}, {name}, {name}.
Present: {name}; {name}; {name}.
Owner: {name}
Speaker: {name}
Contact person is {name}.
Patient {name} was admitted on Tuesday.
My manager, {name}, approved it.
My wife {given} drives on Sundays.
I am {name} from the front desk.
I'm {given}, nice to meet you.
{given} speaking.
The tenant is called {name}.
You remember {name}, right?
{name}'s report was the longest.
We used {given}'s laptop for it.
So {given} went first and {given} followed.
And then {name} took over the shift.
After that {name} closed the meeting.
Best regards, {name}
Sincerely, {name}
{titled} will see you now.
I have an appointment with {titled} at nine.
{titled} from the clinic called back.
As {titled} explained, the results are fine.
Please welcome {titled}.
Who told {titled} about the delay?
The author is {initial}.
{initial} holds the lease.
{initial} took the notes.
{initial} covers the night shift until Sunday.
{name} covers the night shift.
{name} owns the only ladder.
{name} has a spare key.
{name} is on leave until Monday.
{name} runs the front desk.
{given} has a spare key.
{given} has one, {given} has two.
{given} says yes.
{given} said it was fine.
Then {given} said that we should go.
She asked {name} to check the list.
We spoke with {name} about the rent.
Could {name} bring the chairs?
Would {given} read it out?
Let {name} take the first part.
Remind {given} that the gate is open.
Warn {given} before you start.
When does {given} leave?
Is {given} still here?
I wonder whether {given} knows.
I saw {name} at the station.
We trust {given} with the money.
It was built by {name} in one summer.
Paid by {name} in cash.
Led by {given} since the merger.
Show {name} how it works.
Bring {given} along.
Without {given} we are lost.
Behind {given} there was nobody.
{name} and {given} take turns.
Ich habe gestern mit {name} telefoniert.
Können Sie {name} Bescheid geben?
{name} hat heute frei.
{name} kommt etwas später.
{name} schickt uns die Unterlagen.
{given} meinte, das reicht so.
{given} hat das schon erledigt.
Frag doch mal {given}, ob das geht.
Hallo {given}, hörst du mich?
Vielen Dank, {given}.
Das hat mir {name} erzählt.
{titled} hat angerufen.
Der Brief ist von {titled}.
Wir warten noch auf {titled}.
Ich bin {name} und leite die Gruppe.
Ich heiße {name}.
Mit freundlichen Grüßen, {name}
Die Kollegin {name} vertritt mich.
Zuständig ist {name}.
Bei Fragen hilft {name} weiter.
Das wurde von {given} gebaut und von {name} bezahlt.
Die Gruppe wird von {given} geführt.
Erinnere bitte {given} daran.
Zeig {name}, wie es geht.
Ohne {given} wären wir verloren.
Ob {given} noch da ist?
Morgen kommt {name} vorbei.
Unterschrieben von {name} und {name}.
Anwesend: {name}, {name}.
J'ai parlé avec {name} ce matin.
Demandez à {name} ce qu'il en pense.
{name} est absent aujourd'hui.
{name} a envoyé les documents.
{name} va nous rappeler.
{given} dit que c'est trop tôt.
{given} n'était pas là.
Bonjour {given}, tu m'entends ?
Merci beaucoup, {given}.
{titled} vous attend.
La lettre vient de {titled}.
Je suis {name}, du bureau d'accueil.
Mon nom est {name}.
Cordialement, {name}
C'est {name} qui s'en occupe.
Selon {name}, rien n'a changé.
Nous verrons {name} lundi.
Il faut prévenir {given} avant.
Je cherche {name} depuis ce matin.
Où est passé {given} ?
Sans {given}, on est perdus.
Étaient présents {name} et {name}.
Ayer hablé con {name} por teléfono.
Pregunta a {name} si puede venir.
{name} no vino hoy.
{name} ha enviado los papeles.
{name} nos llamará luego.
{given} dice que es pronto.
{given} ya lo sabe.
Hola {given}, ¿me oyes?
Muchas gracias, {given}.
{titled} le espera.
La carta es de {titled}.
Soy {name}, de la oficina.
Mi nombre es {name}.
Saludos, {name}
Lo lleva {name} desde enero.
Según {name}, todo sigue igual.
Hoy llega {name} a firmar.
Dígale a {given} que espere.
Vimos a {name} en la estación.
¿Dónde está {given}?
Sin {given} no hay nada que hacer.
{name} trajo las llaves.
{name} propuso otra fecha.
Firmado por {name} y {name}.
You can text {phone} in an emergency.
Our hotline is {phone}, day and night.
Phone: {phone}
Tel. {phone}
Fax {phone}
Mobile {phone}, office {phone}
Her extension changed, use {phone} now.
I tried {phone} twice and nobody picked up.
Either {phone} or {phone} will do.
If it fails, phone {phone} and wait.
Please call back on {phone} before five.
Call {phone}.
Reach us at {phone}.
{name} answers at {phone} on weekdays.
{given} can be reached on {phone}.
{given} answers {phone} until Friday.
The landlord left {phone} on the door.
I wrote down {phone} for the plumber.
Sie erreichen uns unter {phone}.
Telefon: {phone}
Rufen Sie bitte {phone} an.
Die Durchwahl lautet {phone}.
Handy {phone}, bitte nur abends.
Vous pouvez joindre le bureau au {phone}.
Téléphone : {phone}
Rappelez-moi au {phone} ce soir.
Mon portable, c'est le {phone}.
Puede llamar al {phone} por la mañana.
Teléfono: {phone}
Mi móvil es {phone}.
El número de la oficina es {phone}.
Mail me at {email} tonight.
E-mail: {email}
Contact {email} for a refund.
The invite went out to {email} by mistake.
Questions go to {email}, not to me.
Add {email} and {email} to the list.
Sent from {email}
{name} <{email}>
{name} ({email}) replied first.
Anything for {name} can go through {email} as well.
The account {email} was locked.
From {email} we got no answer.
You find me at {email} or on {phone}.
Bitte eine Nachricht an {email} senden.
Meine Mail lautet {email}.
E-Mail: {email}
Die Rechnung geht an {email}.
Envoyez un message à {email}.
Mon adresse est {email}.
Courriel : {email}
Contactez {email} pour la suite.
Mande un mensaje a {email}.
Mi correo es {email}.
Correo: {email}
Escriba a {email} si falta algo.
My work inbox, {spelled}, fills up fast.
Put {spelled} in copy next time.
It is {spelled}, no capitals.
{spelled} gets all the invoices.
Mine is {spelled} and hers is {spelled}.
Reply to {spelled} by Monday.
Use {email} and nothing else.
Try {email} instead.
Note {email} for later.
Nehmt {email} dafür.
Utilisez {email} pour ça.
Usad {email} para eso.
{email} bounced twice.
{email} wrote back within the hour.
{email} does not exist any more.
{email} ist veraltet.
{email} n'existe plus.
{email} ya no funciona.
{spelled} still works.
{spelled} was the first to answer.
My new number is {phone} from Monday on.
Their number, {phone}, is always busy.
The number you want is {phone}.
The right number is {phone}.
New number {phone}, please tell {given}.
Message for {name}: number {phone} called.
Ask for {given}, number {phone}.
A parcel for {name}, number {phone}, is here.
Room three, {name}, number {phone}.
The number on the card was {phone}.
That number, {phone}, belongs to {name}.
Die Nummer dort ist {phone}.
Le bon numéro est le {phone}.
El número bueno es {phone}.
My social security number is {id}.
SSN: {id}
ID number: {id}
Passport number {id} expires in June.
His driving licence is {id}.
Use {id} as the tax id.
The national insurance number reads {id}.
He typed {id} into the form as his identity number.
Her personal number is {id} and she was born in Ulm.
I lost my identity card, number {id}.
For payroll my tax id is {id}.
It says {id} on my residence permit.
The insured person has number {id}.
Meine Steuer-ID ist {id}.
Die Sozialversicherungsnummer lautet {id}.
Personalausweis {id}, gültig bis März.
Reisepass Nummer {id}.
Ausweis: {id}
Mon numéro fiscal est le {id}.
Numéro de sécurité sociale : {id}
Carte d'identité {id}, passeport {id}.
Mon passeport porte le {id}.
Mi DNI es {id}.
El NIE de la empleada es {id}.
Pasaporte {id}, en vigor.
Número de la seguridad social: {id}
Documento de identidad {id}.
She moved to {address} last year.
Deliver everything to {address} please.
My office is at {address}.
Address: {address}
Billing address: {address}
He grew up at {address} with two brothers.
The clinic has moved to {address}.
Pick me up from {address} at six.
The keys for {address} are lost.
Send it by post to {address}.
{name}, {address}
{name} lives at {address}.
Wir sind umgezogen, neue Anschrift: {address}.
Die Lieferung soll in die {address}.
Adresse: {address}
Er wohnt seit Mai {address}.
Treffpunkt ist {address}.
Nous avons déménagé au {foreign}.
Adresse : {foreign}
Livrez le colis {foreign}.
Elle habite {foreign} depuis mai.
Le bureau se trouve {foreign}.
Nos hemos mudado a {foreign}.
Dirección: {foreign}
Entregue el paquete en {foreign}.
Ella vive en {foreign} desde mayo.
La oficina está en {foreign}.
""".strip().splitlines()

#: Labelled sentences without any.
UNMARKED = """
Invoice {d4}-{d4} was paid on 2023-11-0{d1}.
Reference {d8} belongs to another account.
The part number is {upper}-{d4}-{d2}.
Ticket {upper}{d4} was closed, ticket {d4}-{d4} stays open.
We sold 1,{d3},{d3} units at 4{d1}.{d2} each.
Build 7.{d2}.{d3} breaks the login page.
Listen on port {d4} or {d4}.
The meeting runs from 10:{d2} to 11:{d2} in room {d3}.
See chapter {d2}, figure {d1}.{d1}, and table {d2}.
It was {d2} degrees on 12/0{d1}/2022.
Batch {d3} has {d4} rows and {d2} columns.
Case {upper} {d3} (draft {d1}) was copied.
Serial number {d8}, lot {d2}.
Look for order {d3}-{d4} in the archive.
About {d3} people and {d4} chairs.
The score was {d2} to {d2}, then {d2} all.
It costs {d3} euros, or {d4} with the extra desk.
Meet me @ noon near lane {d2}.
We will meet at the gate, dot the last page, and go.
Look at the map and put a dot at the corner.
The {place} office opens again in spring.
We drive to {place} on Thursday.
The {place} depot was closed for repairs.
The branch in {place} is small.
From {place} to {place} it takes an hour.
Our {place} team has nine people.
{place} is a quiet town.
The bus stops at {place} and at {place}.
Project {word} needs two more weeks.
Project {word} and project {word} share a budget.
The {word} project starts in {month}.
Codename {word} was dropped.
Project {word} has no budget yet.
Project {word} will end in {month}.
Project {word} is on hold until {month}.
Project {word} went well.
Project {word} still lacks a stamp.
Project {word} said nothing about costs.
Then Project {word} came up.
We asked for Project {word} to be closed.
A note on Project {word} is due.
PROJECT {word} runs late.
project {word} has two parts and project {word} has three.
Release {word} ships in {month}.
We renamed Project {word} last week.
In {month} we count everything again.
By {month} it should be done.
Until {month} the roof must hold.
Since {month} nothing has moved.
Before {month} we had no room, after {month} we had too much.
{month} looks busy and {month} looks empty.
{month} ends with a holiday.
{month} was cold this year.
{month} brings {d2} new orders.
Last {month} the old heating failed.
Move it from {month} to {month}.
Let us push the launch to {month} and leave the rest alone.
We moved it to {month} and then to {month} again.
The review slipped to {month}, and nobody minded.
Push it to {month} or drop it.
Shift the delivery to {month} and keep the old date in mind.
We put it off to {month} and keep going.
It goes to {month}, they said.
Postponed to {month} and kept there.
Keep the {month} figures apart from the {month} ones.
The plan for {month} and the plan for {month} differ.
In {month} they were late, in {month} early.
Before {month} the hall was empty, and after that it was full.
Our {month} report lists five faults.
The count from {month} shows nine gaps.
Approved in {month}, so it is old by now.
to {month} and leave the lock as it is.
{month} lists six faults and a warning.
The tally from {month} shows ten errors and a broken seal.
The answer from {month} shows nothing new.
We decided it in {month}, so the list is old.
It was printed in {month}, so the prices are three weeks old.
Early {month} works, late {month} does not.
On {weekday} the shop is closed.
Every {weekday} we clean the kitchen.
See you {weekday}, or {weekday} at the latest.
{weekday} and {weekday} are full.
Sales rose again, and so did the rent.
A rose stood on the table.
A new plan is better than an old one.
A small lamp is better than none.
A revised text went round, a second one did not.
An early start is better than a late one.
I mean, we could wait.
I would, I mean, rather wait.
Costs rose twice, wages rose once.
Wages fell, rents rose, and nobody cared.
The fees, I think, rose by half.
Good, that settles it.
Good, next one.
Fine, so be it.
Outside it was dark.
During the break we ate.
Just wait a moment.
Write it down.
Write the date on the box.
Right, one more time.
Sure, go ahead.
Then again, it may help.
Who has the time to do it?
Who opened the gate?
Who wants to begin?
Can we close this?
Which of them is broken?
Remember to lock up.
Turn left and mark the spot.
Then you mark the wall and cut along the line.
You fold it, mark it and cut it.
Will this work without a cable?
Will anybody check the lock?
Will the second batch fit?
Who will lead the group?
Mark every page that changed.
Mark my words, it will rain.
May I open the window?
May we start with the easy part?
You may sit down, and they may stand.
She may be late, may she not?
Grace periods end at midnight.
With grace and patience it worked.
They gave the tenants a grace period.
Bill the client twice a year.
The bill was too high.
Frank answers help more than polite ones.
To be frank, it was dull.
Sign in at the counter first.
Nobody told Finance about it.
Somebody from Marketing and somebody from Legal came.
Ask Support or Facilities for a key.
The Legal team and the Quality team agree.
Security opens the gate, Catering brings lunch.
Head of Operations is an open position.
The Board of Directors met in public.
Chief Executive Officer is only a title.
The Data Protection Act applies here.
Human Resources moved to the third floor.
Quarterly Business Review slides are ready.
New Year and Easter are both late.
The English version comes first, the French one second.
Germany and Spain have other rules.
Read the User Guide before the Quick Start.
Open the Control Panel and press Restart.
Good morning and welcome back.
Hello everyone, welcome to the course.
Thanks everyone, that was helpful.
Thank you all for coming.
Hi all, can you hear me?
Dear colleagues, please read on.
Best regards from the whole team.
Yes. No. Maybe. Right. Okay then.
Well, that is one way to see it.
Next, we compare both lists.
So the question is simple.
Please open the file and read line {d2}.
First comes the plan, then the vote.
Last week the pump broke twice.
Everybody agreed that the new lock is better.
Nobody answered, so we moved on.
The chair closed the session at five.
What does the manual say about it?
Why is the lamp still broken?
Where did the ladder go?
How long does a copy take?
There are {d1} ways to fold it.
These forms are older than those.
Our neighbours keep bees behind the shed.
Their printer is louder than ours.
I think we should sleep on it.
I said no such thing.
We asked for a ladder and got a rope.
He said it twice, she wrote it down.
They said that the paint was wet.
It says here that the door stays shut.
This is a test, nothing more.
That was the last point on the list.
If it rains, we stay inside.
When the alarm rings, leave by the stairs.
Because of the noise we moved upstairs.
Cache misses slow down the lookup.
Parity bits catch single errors.
The router drops packets when the buffer is full.
Memory paging and address translation are on the exam.
The address bus is {d2} bits wide.
A street map hangs in the hall.
The road was closed, so take the lane on the left.
Close the window, please, and lock the court file away.
We drive on the right side of the road.
One five, two six, three seven, then stop.
Two thousand and nineteen was better than twenty eighteen.
We need four or five more, six at most.
Die Sitzung beginnt um zehn Uhr im großen Saal.
Am {wochentag} bleibt das Büro geschlossen.
Im {monat} zählen wir alles neu.
Die Firma sucht einen neuen Leiter für das Lager.
Der Drucker im dritten Stock ist wieder kaputt.
Das Ergebnis der Prüfung liegt seit gestern vor.
Zum nächsten Treffen bringt bitte jeder einen Stuhl mit.
Wer hat den Schrank im Flur offen gelassen?
Wir müssen die Frist für das Angebot verlängern.
Der {noun} ist fertig, der {noun} noch nicht.
Die {noun} kostet mehr als der {noun}.
Das {noun} liegt auf dem {noun}.
Wir brauchen einen neuen {noun} und eine {noun}.
Wer bringt den {noun} mit?
Bringt bitte den {noun}, sobald er da ist.
Holt mir den {noun}, wenn er trocken ist.
Gebt uns die {noun}, bevor sie weg ist.
Ohne {noun} geht hier nichts.
Mit dem alten {noun} und der neuen {noun} klappt es.
Der späte {noun} ist besser als gar kein {noun}.
Eine davon betrifft den {noun}, zwei betreffen die {noun}.
Es geht um den {noun}. Und um das {noun}.
Dem {noun} fehlt ein {noun}.
Im {noun} steht nichts über den {noun}.
Unser {noun} hängt vom {noun} ab.
{noun} und {noun} sind bestellt.
{noun} gibt es heute keine.
Für die {noun} reicht ein {noun}.
Kein {noun}, keine {noun}.
Das ist kein neuer {noun}, sondern ein alter.
Jeder {noun} braucht einen {noun}, auch der kleine.
Gegen den gemeinsamen {noun} spricht nichts.
Die Abteilung {noun} und die Abteilung {noun} planen das.
Aus der {noun} kam keine Antwort.
Der wichtige {noun}, der alte {noun} und das offene {noun}
den {noun}, wie gesagt
neue {noun} geprüft hat.
Bis nächste {noun} muss es fertig sein.
Diese {noun} und jene {noun} passen.
Letzte {noun} war es kälter.
Hier ist die {noun}, dort der {noun}.
Gut, weiter geht es.
Also gut, fangen wir an.
Niemand weiß, wo der Schlüssel ist.
Niemand hat sich gemeldet.
Zu dem Thema und zu der Frage sagen wir nichts.
Das Thema ist alt, die Frage auch.
Es sind noch zwei Themen offen.
Die Abteilung möchte, dass der Plan bis {wochentag} steht.
Der Plan gefällt der Leitung, sagen sie.
Die Kosten für Strom und Wasser sind gestiegen.
Kann jemand aus dem Einkauf dazu etwas sagen?
Abteilung Einkauf und Abteilung Verkauf teilen sich einen Raum.
Punkt {d1} der Tagesordnung entfällt.
Seite {d2}, Absatz {d1}, Zeile {d2}.
Danke an alle für die Geduld.
Guten Morgen zusammen, schön, dass ihr da seid.
Das Projekt {word} geht in die nächste Runde.
Die Niederlassung in {place} wird größer.
Der Vertrag mit dem Lieferanten läuft im {monat} aus.
Zuerst der Plan, danach die Abstimmung.
Niemand hat gefragt, warum die Tür offen war.
Ich glaube, dass wir morgen weitermachen.
Vielleicht hilft ein neuer Schalter.
Bitte denkt an die Schlüssel für den Keller.
Alle Fenster im Erdgeschoss sind zu.
Der Wert {d4}-{d4} steht auf dem Gerät.
La réunion commence à dix heures dans la grande salle.
Le bureau reste fermé le {jour}.
En {mois} nous recomptons tout.
Personne n'a demandé pourquoi la porte était ouverte.
Merci à tous pour votre patience.
Bonjour à tous et bienvenue.
Bon, on continue.
Bon, alors le point est clos.
Voilà, c'est tout.
Le plan et le rapport sont prêts.
Le service achats cherche un nouveau local.
La facture {d4}-{d4} est déjà payée.
Le projet {word} passe à l'étape suivante.
L'agence de {place} va s'agrandir.
D'abord le plan, ensuite le vote.
Je crois que nous continuerons demain.
Qui a laissé l'armoire ouverte dans le couloir ?
Il faut prolonger le délai de deux semaines.
La page {d2} manque dans le dossier.
Les prix ont encore monté cette année.
Quelqu'un du service qualité peut-il répondre ?
La rue est barrée et la place est vide.
La reunión empieza a las diez en la sala grande.
El {dia} la oficina está cerrada.
En {mes} contamos todo otra vez.
Nadie preguntó por qué la puerta estaba abierta.
Gracias a todos por la paciencia.
Buenos días a todos y bienvenidos.
Bueno, seguimos.
Todavía no hay respuesta.
Para el curso hace falta un cuaderno.
Por favor, cerrad la puerta.
Bueno, entonces queda cerrado.
Vale, eso es todo.
El plan y el informe están listos.
El equipo de compras busca otro local.
La factura {d4}-{d4} ya está pagada.
El proyecto {word} pasa a la siguiente fase.
La sede de {place} va a crecer.
Primero el plan, después la votación.
Creo que seguimos mañana.
¿Quién dejó abierto el armario del pasillo?
Hay que alargar el plazo dos semanas.
Falta la página {d2} del expediente.
Los precios han subido otra vez este año.
¿Puede responder alguien del equipo de calidad?
La calle está cortada y la plaza está vacía.
""".strip().splitlines()

#: Given names that are frequent in several countries.
COMMON_GIVEN = "Aaron Adam Ahmed Aisha Alejandro Alexander Ali Alice Amelia Amir Ana Anders Andrea Anna Anne Antonio Astrid Barbara Beatriz Benjamin Birgit Camille Carlos Carmen Carolina Catherine Charlotte Chen Chiara Christian Claire Claudia Daniel David Diego Dmitri Edward Elena Elizabeth Emily Emma Erik Eva Fatima Felix Fernando Fiona Florian Francesca Frank Gabriel George Giulia Hannah Hans Heinrich Helen Henry Hiroshi Ibrahim Igor Ines Ingrid Isabel Ivan Jack Jacques James Jan Javier Jean Jennifer Jens Johanna John Jonas Jonathan Jorge Joseph Juan Julia Jürgen Karen Karl Katarina Kenji Klaus Laura Lea Leon Linda Lisa Louis Lucas Lucia Luis Mai Manuel Marco Margaret Maria Marie Martin Mary Mateo Matthew Maximilian Mehmet Michael Miguel Mohammed Monika Natalia Nathan Nicolas Nina Noah Olga Oliver Olivia Omar Pablo Patricia Paul Pedro Peter Philippe Pierre Priya Rachel Rafael Raj Rebecca Ricardo Robert Sabine Samuel Sandra Sara Sebastian Sergei Simon Sofia Sophie Stefan Stephanie Susan Sven Thomas Tomasz Ursula Valentina Victor Wei William Wolfgang Yuki Yusuf Yvonne Zoe".split()
_DIGIT_WORDS = "zero one two three four five six seven eight nine".split()
TITLES = "dr mr mrs ms miss professor prof herr frau herrn sr sra señor señora don doña mme m madame monsieur dra doctor doctora sir".split()
_TITLED = ["Dr.", "Dr", "Mr.", "Mr", "Mrs.", "Ms.", "Ms", "Professor", "Prof.", "Herr", "Frau", "Sr.", "Sra.", "Señora", "Mme", "M.", "Madame", "Monsieur", "Don"]
_STREETS = ["Road", "Rd", "Street", "St.", "St", "Avenue", "Ave", "Drive", "Lane", "Crescent", "Close", "Way", "Court", "Square", "Boulevard", "Terrace", "Place"]
_MONTHS = {"month": "January February March April May June July August September October November December", "monat": "Januar Februar März April Mai Juni Juli August September Oktober November Dezember", "mois": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre", "mes": "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre"}
_DAYS = {"weekday": "Monday Tuesday Wednesday Thursday Friday Saturday Sunday", "wochentag": "Montag Dienstag Mittwoch Donnerstag Freitag Samstag Sonntag", "jour": "lundi mardi mercredi jeudi vendredi samedi dimanche", "dia": "lunes martes miércoles jueves viernes sábado domingo"}
CALENDAR = frozenset(w.lower() for x in (*_MONTHS.values(), *_DAYS.values()) for w in x.split())
#: Words that stand in addresses, and words that follow the name of a place.
STREET_WORDS = frozenset("road rd street st avenue ave drive lane crescent close way court square boulevard terrace place flat apt suite box rue impasse quai chemin allée calle avenida plaza paseo camino bis platz".split())
STREET_ENDS = ("straße", "strasse", "weg", "gasse", "allee", "platz", "ufer", "damm", "ring")
PLACE_WORDS = frozenset("bay creek hill valley harbor harbour field bridge park river lake north south east west saint port new upper lower".split())


class Filler:
    """Fills slots by rule: names from lists and made-up syllables, numbers by format."""

    def __init__(self, given: list[str], family: list[str], seed: int = 7):
        self.r = random.Random(seed)
        self.given, self.family = given or COMMON_GIVEN, family or ["Torrell"]

    def slot(self, kind: str) -> str:
        for table in (_MONTHS, _DAYS):
            if kind in table:
                words = table[kind].split()
                # months that are given names too are the hard ones
                return self.r.choice([w for w in words if w in ("April", "May", "June", "August")] or words) if self.r.random() < 0.5 else self.r.choice(words)
        return getattr(self, "given_" if kind == "given" else kind)()

    def digits(self, form: str) -> str:
        return "".join(str(self.r.randint(0, 9)) if c == "#" else c for c in form)

    def syllables(self, low: int = 2) -> str:
        """A made-up word of so many syllables or three, of any letters, so that no ending stands out."""
        part = lambda: self.r.choice(["b", "c", "d", "f", "g", "h", "k", "l", "m", "n", "p", "r", "s", "t", "v", "w", "z", "br", "gr", "sch", "th", "st", "j", "y"]) + self.r.choice("aeiouaeiouéöáü") + self.r.choice(["", "", "l", "n", "r", "s", "m", "t", "x", "ck", "nd", "st"])
        return "".join(part() for _ in range(self.r.randint(low, 3))).capitalize()

    def given_(self) -> str:
        g = self.given_name()
        return g.upper() if self.r.random() < 0.05 else g

    def given_name(self) -> str:
        x = self.r.random()
        if x < 0.05:
            return self.r.choice([g for g in self.given if g.lower() in CALENDAR] or self.given)
        return self.r.choice(self.given) if x < 0.4 else self.r.choice(COMMON_GIVEN) if x < 0.52 else self.syllables()

    def family_name(self) -> str:
        x = self.r.random()
        if x < 0.4:
            return self.r.choice(self.family)
        end = self.r.choice(["son", "mann", "ez", "ski", "eau", "ov", "sen", "berg", "ton", "ini", "er", "field", self.r.choice(self.family)[-4:]])
        return self.syllables(1) + end if x < 0.7 else self.syllables()

    def name(self) -> str:
        g, f, x = self.given_name(), self.family_name(), self.r.random()
        out = f"{g} {f}" if x < 0.56 else g if x < 0.66 else f"{g} {self.r.choice('ABCDEKLMNRST')}. {f}" if x < 0.76 else f"{self.r.choice(_TITLED)} {f}" if x < 0.88 else f"{g[0]}. {f}"
        y = self.r.random()
        return out.upper() if y < 0.08 else out.lower() if y < 0.095 else out

    def titled(self) -> str:
        return f"{self.r.choice(_TITLED)} {self.given_name() + ' ' if self.r.random() < 0.3 else ''}{self.family_name()}"

    def spelled(self) -> str:
        while " at " not in (out := self.email()):
            pass
        return out

    def reversed(self) -> str:
        return f"{self.family_name()}, {self.given_name()}"

    def initial(self) -> str:
        return f"{self.given_name()[0]}. {self.family_name()}"

    def label(self) -> str:
        """A speaker's name as it stands before what is said."""
        x = self.r.random()
        out = f"{self.given_name()} {self.family_name()}" if x < 0.5 else self.reversed() if x < 0.7 else self.initial() if x < 0.85 else self.given_name()
        y = self.r.random()
        return out.upper() if y < 0.12 else out.lower() if y < 0.24 else out

    def phone(self) -> str:
        if self.r.random() < 0.16:
            return " ".join(self.r.choice([*_DIGIT_WORDS, "oh"]) for _ in range(self.r.choice([7, 10])))
        return self.digits(self.r.choice(["(###) ###-####", "###-###-####", "###.###.####", "### ### ####", "+1 ### ### ####", "+1-###-###-####", "1##########", "1##########", "##########", "+44 20 #### ####", "0### ### ####", "020 #### ####", "+49 30 #######", "0049 30 ##### ###", "+49 ### #######", "0## ########", "0####/######", "0# ## ## ## ##", "+33 # ## ## ## ##", "+34 ### ### ###", "### ## ## ##", "6## ### ###", "1555#######", "(555) 555-01##"]))

    def id(self) -> str:
        return self.digits(self.r.choice(["###-##-####", "###-##-####", "######-####", "19######-####", "########-####", "##/###/#####", "X#######", "Y#######", "Z#######M", "X#######K", "L########", "C##K####J", "QQ ## ## ## C", "QQ ## ## ## D", "AB ## ## ## A", "AB######C", "## ### ### ###", "9##-##-####", "########Z", "########H", "# ## ## ## ### ### ##", "AB#######", "## ###### A ###"]))

    def email(self) -> str:
        who = self.r.choice([f"{self.given_name()}.{self.family_name()}", f"{self.given_name()[0]}.{self.family_name()}", f"{self.family_name()}_{self.digits('##')}", f"info-{self.family_name()}", f"{self.given_name()}+{self.r.choice(['notes', 'list', 'news'])}", f"{self.given_name()[0]}{self.family_name()}", f"{self.given_name()}{self.digits('##')}", "office", "info." + self.family_name(), self.given_name()]).lower()
        host = self.r.choice([self.syllables().lower(), self.syllables().lower() + self.r.choice(["mail", "desk", "post", "house", "mill", "field"]), "gmail", "web", "example", "mail-" + self.syllables().lower()]) + "." + self.r.choice(["example", "test", "invalid", "com", "org", "net", "de", "fr", "es", "co.uk", "io", "eu"])
        x = self.r.random()
        if x < 0.45:
            out = f"{who}@{'mail.' * (self.r.random() < 0.2)}{host}"
            return out.upper() if self.r.random() < 0.25 else out
        if x < 0.58:
            return who + "[at]" + host.replace(".", "[dot]")
        if x < 0.72:
            return who + " (at) " + host.replace(".", " (dot) ")
        return who.replace(".", " dot ").replace("+", " dot ").replace("_", " dot ") + " at " + host.replace(".", " dot ")

    def address(self) -> str:
        place, number = self.syllables() + self.r.choice(["by", "wick", "vale", "ham", "mere", "bach", ""]), str(self.r.randint(1, 250))
        if self.r.random() < 0.15:
            place = "Port-" + self.syllables()
        road = f"{number} {self.syllables()}{self.r.choice(['', '', '-Pike'])} {self.r.choice(_STREETS)}"
        german = f"{self.syllables()}{self.r.choice(STREET_ENDS)} {number}"
        form = self.r.choice([road, road, f"{road}, {place}", f"{road}, {place} {self.digits('#####')}", f"Flat {self.r.randint(1, 30)}, {road}, {place}", f"P.O. Box {self.r.randint(100, 1900)}, {place}", f"{german}, {self.digits('#####')} {place}", german])
        return form.upper() if self.r.random() < 0.2 else form

    def foreign(self) -> str:
        place, number = self.syllables(), str(self.r.randint(1, 250))
        return self.r.choice([f"{number} bis, avenue de {place}", f"{number} bis, impasse de {place}", f"{number}, rue de {place}", f"{number} rue {place}", f"{number}, place de {place}", f"{number} boulevard {place}, {self.digits('#####')} {self.syllables()}", f"calle {place} {number}", f"la calle de {place}, {number}", f"Calle {place}, {number}", f"avenida {place} {number}", f"la plaza de {place} {number}, {self.digits('#####')} {self.syllables()}"])

    def place(self) -> str:
        x, w = self.r.random(), self.syllables()
        return f"{w} {self.r.choice(['Bay', 'Creek', 'Hill', 'Bridge', 'Park', 'Valley'])}" if x < 0.4 else f"{self.r.choice(['Port', 'North', 'Upper', 'Lake', 'New'])} {w}" if x < 0.6 else w

    def word(self) -> str:
        return self.syllables() + self.r.choice(["", "", "leaf", "vale", "water", "back", "finch", "spur"])

    def noun(self) -> str:
        """A made-up noun, as German writes them."""
        return self.syllables(1) + self.r.choice(["", "", "ung", "heit", "plan", "bogen", "werk", "zeug", "raum", "schein", "trag", "lauf", "stoff", "satz", "er", "e"])

    def upper(self) -> str:
        return "".join(self.r.choice("ABCDEFGHKLMNPQRSTUVWXYZ") for _ in range(self.r.randint(2, 4)))

    def d1(self) -> str:
        return self.digits("#")

    def d2(self) -> str:
        return self.digits("##")

    def d3(self) -> str:
        return self.digits("###")

    def d4(self) -> str:
        return self.digits("####")

    def d8(self) -> str:
        return self.digits("########")

    def sound(self) -> str:
        """A sound annotation in brackets."""
        sound = self.r.choice("laughs laughter applause cheering music noise coughs sighs silence static crosstalk cross_talk door_closes door_opens background_noise phone_ringing clears_throat inaudible unintelligible".split()).replace("_", " ")
        sound = sound.upper() if self.r.random() < 0.4 else sound
        return self.r.choice([f"[{sound}]", f"[{sound}]", f"({sound})", f"*{sound}*"])

    def opening(self) -> str:
        """What a line may open with that isn't said: time marks, numbered labels, bullets, sounds."""
        if self.r.random() < 0.25:
            return self.sound()
        return self.digits(self.r.choice(["00:##:##,### --> 00:##:##,###", "[0#:##:##]", "(0#:##)", "<00:##:##.###>", "0#:##:## -", "SPEAKER_0#:", "[SPEAKER_0#]", "[SPEAKER_1#]", "Speaker #:", ">> Speaker #:", "SPEAKER 0# -", "spk_#:", "[spk_#]", "[Speaker #]", "[UNKNOWN]", "-", "*", "#.", "Q:", "A:"]))
