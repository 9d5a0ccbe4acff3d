"""Refusals and sound answers in other words than those the patterns were written with."""

REFUSED = """
This request falls outside what I'm permitted to do.
I'd rather not go into that material.
Unfortunately I am not allowed to work with this conversation.
That task is beyond the scope of what can be done here.
I won't be producing a recap of this exchange.
Without a transcript to look at, I have nothing to condense.
I don't have any text to go on.
Sorry, no can do.
It isn't possible for me to share details of that talk, and I cannot continue.
I must pass on this request.
We regret it, but I can't comply.
Processing this is not something I am able to do.
Kindly share the passage you would like me to look at.
If you paste the recording's text, I will gladly take a look.
The transcript appears to be blank.
I am unable to open the document you mention.
I refuse to summarise this.
I'm not comfortable describing what was said.
Your request cannot be fulfilled.
As a language model I have no access to that meeting.
Das darf ich leider nicht machen.
Dazu bin ich nicht befugt.
Diese Anfrage übersteigt meine Möglichkeiten und ich kann sie nicht erfüllen.
Ich möchte mich dazu nicht äußern.
Hierbei kann ich Ihnen nicht weiterhelfen.
Mir ist es nicht gestattet, dieses Gespräch wiederzugeben.
Ich sehe keine Möglichkeit, das zu bearbeiten.
Entschuldigung, dafür fehlt mir die Grundlage.
Bitte schicken Sie mir zuerst die Mitschrift.
Ich bedauere, das geht so nicht.
No estoy autorizado a hacer eso.
Me es imposible ofrecer un resumen.
No me está permitido describir esta charla.
Esta petición excede lo que puedo hacer.
Mis disculpas, no voy a continuar con ello.
No puedo dar esa información.
Me niego a condensar el diálogo.
Por favor, envíame primero el texto completo.
Lamento no servir de ayuda aquí.
No se me permite tratar este material.
Je ne suis pas autorisé à faire cela.
Cette demande dépasse mes attributions.
Je regrette, ce n'est pas faisable.
Il m'est interdit de reprendre cet échange.
Je n'ai pas accès à ce contenu.
Je me vois contraint de décliner.
Je ne souhaite pas donner suite.
Merci de joindre d'abord la transcription.
Désolée, impossible d'aller plus loin.
Votre requête sort de mon champ d'action.
Non posso riassumere questa conversazione.
Mi dispiace, non sono autorizzato a farlo.
Questa richiesta esula dai miei compiti.
Devo rifiutare questo incarico.
Não consigo resumir essa conversa.
Sinto muito, não estou autorizado a fazer isso.
Este pedido está fora do meu alcance.
Ik ben niet bevoegd om dit samen te vatten.
Het spijt me, dat gaat niet.
Dit verzoek valt buiten mijn mogelijkheden.
Helaas kan ik hier niet mee verder.
Ik mag dit gesprek niet behandelen.
""".strip().splitlines()

SOUND = """
The vendor said that they cannot deliver before spring, so the order moves to another firm.
Nobody was able to open the hall, and the class met outside.
The group agreed not to buy a second van this year.
They asked for the text of the lease and will read it next week.
Two people were sorry to miss the lunch. The rest enjoyed it.
The request for a new lamp was turned down by the board.
Der Antrag wurde nicht angenommen, weil das Geld fehlt.
Die Gruppe konnte den Raum nicht öffnen und traf sich draußen.
Le comité n'a pas voté le budget. Il y reviendra en mai.
Personne n'a pu ouvrir la salle, le cours a eu lieu dehors.
El comité no aprobó el gasto. Se tratará otra vez en mayo.
Nadie pudo abrir la sala y la clase fue en el patio.
Il gruppo non ha approvato la spesa e ne parlerà a maggio.
O grupo não aprovou a despesa e volta ao tema em maio.
De groep heeft de uitgave niet goedgekeurd en komt er in mei op terug.
""".strip().splitlines()
