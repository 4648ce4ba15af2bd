"""Fixed values for problem 9: general terms of abuse, hate and sex in seven languages.

Each class lists words of the language in common use, a trailing ``*`` standing for any
inflection or short ending.  No class decides alone: weights and contexts are in
``abuse.py``, and what else judged documents say is learned from them.
"""

# Names for a person that insult by themselves.
INSULT = {
    "en": "idiot* moron* imbecile* scumbag* halfwit* dimwit* nitwit* twit twits loser* bastard* asshole* arsehole* dickhead* bitch* jerk* fool fools dumbass* jackass* cretin* wanker* prick pricks douchebag* scum dumbo airhead* bonehead* blockhead* wimp weakling* motherfucker* shithead* bullshitter* crybaby whore* slut* hypocrite* twerp* numskull* simpleton* tosser* pillock*",
    "de": "idiot* trottel* vollpfosten depp* schwachkopf* dummkopf* dreckskerl* drecksack* dreckstuck* arschloch* arschlocher* vollidiot* blodmann* wichser* hurensohn* versager* penner* spast* hohlkopf* mistkerl* miststuck* saukerl* flachzange* scheisskerl* schlampe* hure* vollhonk* dumpfbacke* nichtsnutz* lump* schweinehund* weichei* knallkopf* missgeburt* pfeife blodian*",
    "fr": "idiot* imbecile* cretin* abruti* ordure* connard* connasse* salaud* salope* con conne enfoire* debile* minable* bouffon* pauvrecon* batard* raclure* clochard* tocard* bourrique couillon* encule* pute putain* trouduc* andouille* branleur* salopard* vaurien* pourriture* demeure*",
    "es": "idiota* imbecil* cretino* gilipollas cabron* estupido* inutil* payaso* subnormal* capullo* pendejo* cerdo* bastardo* maldito* tonto* mamon* zorra* puta puto desgraciado* canalla* imbeciles mierdoso* zopenco* memo tarado* malnacido* hijoputa*",
    "it": "idiota* imbecille* cretino* cretina* stronz* coglione* coglioni deficiente* scemo* scema pagliaccio* bastardo* stupido* puttana* troia* testadicazzo incapace* fallito* miserabile* cornuto* buffone* verme ritardato* mentecatto* cazzone* rincoglionito* zoccola* carogna*",
    "nl": "idioot idioten sukkel* klootzak* eikel* kloothommel* stommeling* lul hoerenzoon* mongool* sukkels trut* kutwijf rotzak* prutser* klojo* debiel* mafkees* lafaard* nietsnut* randdebiel* slet* hoer hufter* etterbak* viezerik* schoft*",
    "pt": "idiota* imbecil* cretino* babaca* otario* estupido* burro* burra inutil* palhaco* desgracado* canalha* cabrao filho-da-puta puta vagabundo* vagabunda* corno merdoso* arrombado* trouxa* retardado* fracassado* palerma* cuzao* vadia* besta",
}

# Adjectives and nouns that insult only when they are aimed at a person.
SCORN = {
    "en": "stupid* dumb pathetic worthless useless brainless clown* trash garbage pig pigs disgusting bloody dirty ugly fat filthy miserable ridiculous incompetent lazy rat rats snake coward* liar* nobody joke ashamed blind waste",
    "de": "dumm* blod* damlich* erbarmlich* wertlos* nutzlos* widerlich* elend* dreckig* hasslich* fett* faul* lacherlich* armselig* kuh sau schwein* hund ratte abschaum mull dreck schande feigling* lugner* niemand witz unfahig*",
    "fr": "stupide* nul nulle sale pauvre pathetique* inutile* degoutant* moche* gros grosse ridicule* incapable* lache paresseux porc* cochon* chien rat vermine honte merde blague menteu* type",
    "es": "patetico* asqueroso* feo fea gordo gorda ridiculo* incompetente* vago* basura mierda rata perro cobarde* mentiroso* verguenza asco sucio* miserable* broma nadie",
    "it": "patetico* schifoso* brutto brutta grasso grassa ridicolo* incompetente* pigro* spazzatura merda ratto cane codardo* bugiardo* vergogna schifo sporco* maiale* inutile* nulla nullita barzelletta",
    "nl": "stom* dom domme zielig* waardeloos waardeloze nutteloos nutteloze walgelijk* lelijk* vet lui luie belachelijk* ezel varken* vuil rat hond lafbek leugenaar* schande tuig stront grap niemand",
    "pt": "patetico* nojento* feio feia gordo gorda ridiculo* incompetente* preguicoso* lixo merda rato cachorro covarde* mentiroso* vergonha nojo sujo* miseravel* piada porco* ninguem",
}

# What is threatened, wished or ordered to somebody.
HOSTILE = {
    "en": "kill* hurt* beat* punch* smash* strangle* crush* stab* shoot* murder* destroy* slap* kick* break* hell hate* despise* die dies choke* drown* rot hang disappear* vanish* shut fired regret* smack* burn* bleed* piss* screw* suffer* cripple* throttle*",
    "de": "tote* umbring* bringe schlag* verprugel* verprugle* brech* zerschlag* zerquetsch* erwurg* ersticke* stech* hasse hasst verachte* stirb sterbe* verrecke* holle klappe maul fresse verschwinde* verpiss* verzieh* hau fertig* bereuen* leiden schnauze kriech* kotz* umleg* prugel* ausstehen rausschmei* rauswerf* abstech*",
    "fr": "tue tuer tuerai frapp* casse* cogne* ecras* etrangl* detest* hais hair meprise* creve* mourir meurs enfer gueule degage* disparais* disparai* ferme regrett* souffrir tais pends foutre crache* bute buter eclate* supporte* tabass*",
    "es": "mato matar matare golpe* pego romper* rompo aplast* estrangul* odio odia desprecio* muere* morir infierno boca callate calla largate largo desaparece* arrepent* sufrir joder jodete jode partir* parto reviento reviente* ahorc* aguanta* apunal* escup*",
    "it": "ammazz* uccid* picchi* rompo rompere spezzo spezz* schiacci* strangol* odio odia disprezz* crepa* morire muori inferno bocca zitto zitta sparisci* vattene pent* soffr* fottiti fanculo vaffanculo spacc* impicc* sopport* vomit* becco accoltell* sput*",
    "nl": "vermoord* dood sla slaan breek breken verpletter* wurg* haat veracht* sterf stik hel bek smoel opdonder* oprotten rot verdwijn* donder* spijt lijden lazer* kop verrek* uitstaan kots* maak oppleur* steek neersteek* kapotmaak* aftuig*",
    "pt": "mato matar matarei bato bater quebr* esmag* estrangul* odeio odeia desprez* morra morre* inferno boca cala cale suma some sumir desaparec* arrepend* sofrer foda foder fode arrebent* enforc* aguent* suport* surra espanc* esfaque* cusp*",
}

# Parts of a person that are hurt.
BODY = {
    "en": "mouth face finger fingers bones teeth neck skull throat head leg legs arm arms nose ass butt life yourself guts",
    "de": "mund gesicht finger* knochen zahne hals schadel kehle kopf beine bein arm arme nase arsch leben luft rippen",
    "fr": "bouche visage doigts doigt os dents cou crane gorge tete jambes bras nez cul vie air",
    "es": "cara dedos dedo huesos dientes cuello craneo garganta cabeza piernas brazos nariz culo vida aire",
    "it": "faccia dita dito ossa denti collo cranio gola testa gambe braccia naso culo vita aria muso",
    "nl": "mond gezicht vingers vinger botten tanden nek schedel keel hoofd benen armen neus reet leven lucht",
    "pt": "cara dedos dedo ossos dentes pescoco cranio garganta cabeca pernas bracos nariz bunda vida ar",
}

# Somebody is spoken to.  Words that are also the subject of plain sentences count only behind a hostile word.
ADDRESS = {"en": "you your yourself u ur ya", "de": "du dich dir dein deine deinen deiner deinem deines euch euer eure", "fr": "tu te toi ton ta tes", "es": "te tu tus ti eres vosotros", "it": "ti te tu tuo tua tuoi tue sei", "nl": "jou jouw jullie je jij", "pt": "te ti voce teu tua teus tuas seu sua"}
SUBJECT = "you your je voce seu sua"

# Groups that people are counted to by origin or faith.
GROUP = {
    "en": "foreigner* immigrant* migrant* refugee* asylum* race races ethnic* tribe* nation country jew jews muslim* arab* african* asian* gypsies gypsy blacks whites folk breed origin* native* town blood skin born",
    "de": "auslander* einwanderer* migrant* fluchtling* asylant* rasse* volk stamm juden jude muslim* moslem* araber* afrikaner* asiat* zigeuner* turken land herkunft fremde* brut blut hautfarbe geboren* geburt stadt sippe",
    "fr": "etranger* immigre* migrant* refugie* race* ethnie* peuple* juif* juifs musulman* arabe* africain* asiatique* tsigane* pays origine* sang peau ville naissance nes",
    "es": "extranjero* inmigrante* migrante* refugiado* raza* etnia* pueblo judio* musulman* moro moros arabe* africano* asiatico* gitano* pais origen sangre piel ciudad nacidos",
    "it": "stranier* immigrat* migrant* rifugiat* profugh* razza razze etnia* popolo ebreo ebrei musulman* arabo arabi african* asiatic* zingar* paese origine sangue pelle citta nati",
    "nl": "buitenlander* immigrant* migrant* vluchteling* asielzoeker* ras rassen volk stam jood joden moslim* arabier* marokkanen afrikaan* aziaat* zigeuner* land afkomst bloed huidskleur stad geboren",
    "pt": "estrangeiro* imigrante* migrante* refugiado* raca racas etnia* povo judeu* muculmano* arabe* africano* asiatico* cigano* pais origem sangue pele cidade nascidos",
}

# What people are called who are not taken for people.
VERMIN = {
    "en": "vermin* rat rats parasite* plague pest pests disease* cockroach* animal animals filth subhuman* savage* scum maggot* inferior* rotten cancer thieves thief criminals dirt garbage lice barbarian* apes monkeys infest*",
    "de": "ungeziefer ratten parasit* plage seuche* pest schadling* kakerlake* tiere abschaum untermensch* minderwertig* verdorben* krebsgeschwur diebe dreck bestien wilde affen gesindel pack laus lause schmarotzer* verbrecher* barbaren unrat",
    "fr": "vermine rats parasite* peste fleau maladie* cafard* animaux betes sauvages sous-hommes inferieur* pourri* cancer voleurs racaille crasse singes poux barbares nuisibles criminels vol",
    "es": "alimanas ratas parasito* plaga peste enfermedad* cucaracha* animales bestias salvajes infrahumanos inferior* podrid* cancer ladrones escoria chusma monos piojos barbaros criminales robo",
    "it": "parassit* ratti topi peste piaga malattia* scarafagg* animali bestie selvaggi subuman* inferior* marci* cancro ladri feccia gentaglia scimmie pidocchi barbari criminali immondizia furto",
    "nl": "ongedierte ratten parasiet* parasieten pest plaag ziekte* kakkerlak* dieren beesten wilden ondermens* minderwaardig* verrot* bedorven kanker dieven uitschot gespuis apen luizen barbaren criminelen",
    "pt": "ratos parasita* praga peste doenca* barata* animais bestas selvagens subumanos inferior* podre* cancer ladroes escoria ralé macacos piolhos barbaros criminosos lixo roubo",
}

# What is demanded against groups, or said of them as a whole.
EXPEL = {
    "en": "exterminat* eradicat* deport* expel* thrown throw kick send back burn burned gas gassed wipe cleanse* lazy dirty breed* steal* invad* rights decent human lynch* shot hang fence behind crawled rid belong* pure purge* ruin* destroy* kill*",
    "de": "vernicht* ausrott* ausweis* abschieb* gejagt jagt rauswerfen raus zuruck verbrenn* vergas* zundet brenn* saubern faul dreckig vermehr* stehl* rechte anstandig* mensch menschen zaun hergekroch* weg gehoren rein uberfremd* totet erschiess* zerstor*",
    "fr": "extermin* eradiqu* expuls* chass* renvoy* dehors brul* gaz* nettoy* paresseux sale* reproduis* volent envahi* droits honnet* humains cloture trou pendre fusill* vire* purifi* detruis* tuer tuez",
    "es": "extermin* erradic* expuls* echar* fuera devolv* mandad* quem* gase* limpiar* vagos perezosos sucios reproduc* roban invad* derechos decente* honesta* humanos valla agujero colgar fusil* purific* destru* matar matad",
    "it": "stermin* sradic* espuls* espell* cacciat* cacci* fuori rimand* bruci* gas ripulir* pigri sporchi moltiplic* riproduc* rubano rubare invad* diritti perbene onesta umani recinto buco impicc* fucil* distrugg* ammazz* uccid*",
    "nl": "uitroei* verdelg* uitzet* uitgezet gejaagd weg terug verbrand* vergas* brand steek zuiver* lui vies vuil voortplant* planten stelen invasie rechten fatsoenlijk* nette mens mensen hek hol ophang* neerschiet* opsluit* verniet* doden",
    "pt": "extermin* erradic* expuls* fora devolv* mandem mandar queim* gas limpar preguicos* sujos multiplic* reproduz* roubam invad* direitos decente* honesta* humanos cerca buraco enforc* fuzil* destru* matar matem",
}

# Words for sex that hardly occur elsewhere.
EXPLICIT = {
    "en": "orgasm* porn* pussy pussies blowjob* cum cumming horny tits boobs nude nudes erotic* masturbat* penis vagina clit* erection* dildo* threesome* fucked fucking fuck hooker* ejaculat* anal bdsm nipple* cunt*",
    "de": "orgasm* porno* ficken fick fickt gefickt muschi fotze* titten nacktbild* nacktfoto* erotik* erotisch* geil geile wichsen penis vagina erektion* dildo* blasen schwanz bums* vogeln nippel* sperma ejakul*",
    "fr": "orgasm* porno* baiser baise baisee chatte* bite seins nichons erotique* masturb* penis vagin erection* sodom* partouze* jouir jouis sperme fellation* branle* sucer suce sucent bander teton* levrette",
    "es": "orgasm* porno* follar folla follando follamos cono tetas erotic* masturb* pene vagina ereccion* polla mamada* correrte correrme correrse semen pezon* chupar chupa desnudez cachond*",
    "it": "orgasm* porno* scopare scopa scopo scopano scopato figa fica tette erotic* masturb* pene vagina erezione* cazzo pompino* sborra* capezzol* spogliarti spogliarsi succhia* eccitat*",
    "nl": "orgasme* porno* neuken neuk neukt geneukt kut tieten naaktfoto* erotisch* masturb* penis vagina erectie* pijpen klaarkom* klaar-komen sperma tepel* geil geile beffen",
    "pt": "orgasm* porno* foder foda fodendo buceta* peitos tetas erotic* masturb* penis vagina erecao* gozar gozou goza gozando boquete* pau tesao mamilo* transar transa transando chupar punheta*",
}

# Words that are about sex only beside others of this class or the one before.
INTIMATE = {
    "en": "sex sexy naked bare breast breasts thigh thighs bra panties bed moan* lust kiss* undress* strip* lick* suck* stroke* caress* lover* intercourse body adult uncensored singles cock dick seduc* intimate* nudity aroused arousing desire* passion*",
    "de": "sex nackt* brust bruste schenkel* bh slip bett stohn* lust kuss* ausziehen auszog auszieh* zog streichel* leck* beischlaf liebhaber* korper unzensiert* singles schlafen kommst kommen verfuhr* begier* leidenschaft* erreg* feucht trieben intim* unterwasche",
    "fr": "sexe sexuel* nu nus nue nues sein cuisse* soutien-gorge soutien culotte lit gemiss* gemir plaisir embrass* deshabill* lecher leche caress* amant* corps adulte* censure celibataires torride* seduire desir* passion* amour mouille* intime* excit*",
    "es": "sexo sexual* desnud* pecho pechos muslo* sujetador bragas cama gemi* placer beso besa besaba desvest* lamer lame acarici* amante* cuerpo adultos censura solteros salvaje seduc* deseo pasion amor mojad* intim* excit*",
    "it": "sesso sessual* nudo nuda nudi nude seno seni coscia cosce reggiseno mutandine letto gem* piacere baci* spogli* lecc* accarezz* amante* corpo adulti censura single spinto sedur* desiderio passione amore bagnat* intim* spogliò",
    "nl": "seks sexy seksueel naakt* blote borst borsten dij dijen beha slipje bed kreun* lust kus* uitkleden uitkleed likken lik streel* strel* minnaar* lichaam volwassenen ongecensureerd* singles verleid* verlang* passie liefde nat intiem* opgewonden",
    "pt": "sexo sexual* nu nua nus nuas peito seio seios coxa* sutia calcinha cama gem* prazer beijo* beijou beij* despir* despiu lamber lambe acarici* amante* corpo adultos censura solteiros selvagem seduz* desejo paixao amor molhad* intim* excit*",
}

# Whole expressions that are abusive whatever stands beside them.
IDIOMS = {
    "en": "shut up|shut your mouth|get lost|go to hell|drop dead|screw you|fuck you|fuck off|piss off|kill yourself|kick your ass|son of bitch|burn in hell|be ashamed|piece of shit|piece of trash|piece of crap",
    "de": "halt die klappe|halt dein maul|halts maul|halt die fresse|fahr zur holle|geh zum teufel|verpiss dich|hau ab|leck mich|fick dich|bring dich um|stuck dreck|stuck scheisse|du hund|scham dich|schamen sie sich",
    "fr": "ta gueule|ferme la|va te faire|va au diable|va en enfer|fous le camp|casse toi|nique ta mere|fils de pute|pauvre type|sac a merde|tas de merde",
    "es": "cierra la boca|callate la boca|vete al infierno|vete al diablo|vete a la mierda|hijo de puta|que te jodan|vete al carajo|pedazo de mierda|pedazo de basura|das asco",
    "it": "chiudi la bocca|chiudi il becco|va all inferno|vai al diavolo|va a quel paese|vai a cagare|figlio di puttana|fatti fottere|pezzo di merda|fai schifo|buono a nulla",
    "nl": "hou je bek|hou je kop|loop naar de hel|loop naar de duivel|rot op|val dood|krijg de|sterf maar|flikker op|stuk stront|stuk vuil|stuk tuig",
    "pt": "cala a boca|cala essa boca|vai para o inferno|va para o inferno|vai se foder|vai a merda|filho da puta|vai tomar no|pedaco de merda|pedaco de lixo",
}

# Wording around an insult that quotes, forbids or reports it.
MENTION = "colleague* kolleg* colega* collega* compane* collegue* rule rules reglement* reglamento* regolamento* regulamento* hausordnung huisregels forbid* prohibit* verbiet* verbot* prohib* interdit* interdi* vietat* vietano verbied* verboden proib* clause klausel* training* schulung* harassment belastigung* word words wort worte wort* mot mots palabra* parola parole palavra* woord* message messages nachricht* message* mensaj* messagg* bericht* mensag* policy richtlinie* report* complain* complaint* beschwerde* plainte* queja* reclam* klacht* denounc* insult* beleidig* insult* beledig*"
